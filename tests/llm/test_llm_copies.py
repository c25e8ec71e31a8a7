"""Near copies, repeated lines, components and the pipeline."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_data import WORD, Groups, no_documents, odd_documents, rows, text
from pyspark.sql import functions as F

import corpus_pipeline
from inkspan.llm import lines, queries, simhash, toxicity
from inkspan.llm.graph import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _fingerprint(text):
    words = WORD.findall(text.translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_of_chains_stars_and_rings(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 40)] + [(7, 7), (9, 8), (8, 9)]
    edges += [(1000 + draw.randrange(80), 1000 + draw.randrange(80)) for _ in range(60)]
    draw.shuffle(edges)
    plain = Groups({x for e in edges for x in e})
    for a, b in edges:
        plain.join(max(plain.top(a), plain.top(b)), min(plain.top(a), plain.top(b)))
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    known = {r.node: r.root for r in found}
    assert len(known) == len(found) and known == {x: plain.top(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _numbers(draw, groups, flips):
    found = []
    for _ in range(groups):
        base = draw.getrandbits(64)
        found.append(base)
        for _ in range(draw.randrange(6)):
            found.append(found[-1 - draw.randrange(1)] ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(flips + 1))))
    return found


@pytest.mark.parametrize("shard_rows", [1 << 15, 40])
def test_links_in_one_or_many_shards_connect_what_pairs_connect(spark, shard_rows):
    found = sorted(set(_numbers(random.Random(11), 150, 3)))
    plan = simhash.Plan(shingle=3, words=1, most=2, shard_rows=shard_rows)
    table = spark.createDataFrame(
        [(n - (n >> 63 << 64), bytearray(n.to_bytes(8))) for n in found], "node long, sketch binary"
    )
    plain, ours = Groups(range(len(found))), Groups(range(len(found)))
    for i, a in enumerate(found):
        for j in range(i):
            if (a ^ found[j]).bit_count() <= 2:
                plain.join(i, j)
    place = {n - (n >> 63 << 64): i for i, n in enumerate(found)}
    edges = simhash.links(table, plan).collect()
    for e in edges:
        ours.join(place[e.a], place[e.b])
    same = lambda g: {frozenset(x for x in range(len(found)) if g.top(x) == t) for t in {g.top(x) for x in range(len(found))}}
    assert same(plain) == same(ours) and len(edges) > 50
    spread = simhash.dealt(table, plan, simhash.shard_trees(table, plan, len(found)))
    assert spread.where("NOT asks").count() == len(found)
    assert (spread.select("shard").distinct().count() > 4) == (shard_rows == 40)


def test_long_lists_are_connected_without_all_pairs(monkeypatch):
    draw = random.Random(4)
    base = draw.getrandbits(64)
    near = [base ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64) for _ in range(300)]
    found = np.array(sorted({*near, base, *_numbers(draw, 60, 3)}), np.uint64)[:, None]
    monkeypatch.setattr(simhash, "_BLOCK", 256)
    monkeypatch.setattr(simhash, "LEAF", 8)
    shard = simhash.Shard((0, 0), simhash.SHORT, 0)
    ids = np.arange(len(found))
    pairs = [*zip(*shard.take(np.repeat([False, True], len(found)), np.tile(ids, 2), np.tile(found, (2, 1))))]
    pairs += [*zip(*shard.stars())]
    plain, ours = Groups(ids.tolist()), Groups(ids.tolist())
    for a, b in pairs:
        assert a != b
        ours.join(int(a), int(b))
    for i in ids:
        for j in np.flatnonzero(simhash.distance(found[:i, 0], found[i, 0]) <= 2):
            plain.join(int(i), int(j))
    assert len(pairs) <= 2 * len(found)
    assert all((plain.top(i) == plain.top(j)) == (ours.top(i) == ours.top(j)) for i in ids.tolist() for j in range(i))


def test_short_sketches_against_plain_python(spark):
    found = simhash.near_groups(odd_documents(spark), simhash.SHORT).collect()
    marks = {}
    for i, t, *_ in rows():
        if t is None or len(t) < 40_000:
            marks.setdefault(_fingerprint(t or ""), []).append(i)
    long = next(t for i, t, *_ in rows() if i == 306)
    marks.setdefault(_fingerprint(long), []).append(306)
    plain = Groups(marks)
    for a in marks:
        for b in marks:
            if (a ^ b).bit_count() <= 2:
                plain.join(a, b)
    least = {}
    for mark, ids in marks.items():
        known = [i for i in ids if i is not None]
        least[plain.top(mark)] = min([*known, *([least[plain.top(mark)]] if least.get(plain.top(mark)) is not None else [])], default=None)
    assert len(found) == len(rows())
    for r in found:
        mark = int.from_bytes(r.sketch)
        if r.doc_id != 307:
            assert mark in marks and r.doc_id in marks[mark] and r.component_id == least[plain.top(mark)]
    assert next(r for r in found if r.doc_id == 300).sketch == bytes(8)
    assert simhash.near_groups(no_documents(spark), simhash.SHORT).count() == 0


def test_one_of_each_group_stays(spark):
    docs = odd_documents(spark)
    out = simhash.one_of_each(docs)
    assert out.columns == docs.columns
    kept = Counter(r.doc_id for r in out.collect())
    assert set(range(1, 30)) - {3, 9} <= set(kept) and kept[0] == 1 and not {100, 101, 102, 103, 104} & set(kept)
    assert len({200, 201, 202, 203, 204, 1} & set(kept)) == 1  # one word of 67 is changed
    assert kept[-5] == 1 and 3 not in kept and kept[7] == 1 and kept[8] == 2  # two texts have id 8
    assert len({300, 301, 302} & set(kept)) == 1 and kept[9] == 1 and kept[None] == 1
    assert simhash.one_of_each(no_documents(spark)).count() == 0


def test_similarity_of_long_sketches():
    draw = random.Random(2)
    for share, linked in ((0.01, True), (0.002, True), (0.1, False)):
        hits = 0
        for seed in range(20):
            words = text(600, seed).split(" ")
            other = [f"x{draw.random()}" if draw.random() < share else w for w in words]
            a, b = (simhash.as_words([simhash.sketch(" ".join(w), simhash.LONG)], simhash.LONG) for w in (words, other))
            hits += np.bitwise_count(a ^ b).sum() <= simhash.LONG.most
        assert hits >= 18 if linked else hits == 0


def test_long_links_are_exactly_the_pairs_of_similarity_0_8(spark):
    draw, docs = random.Random(9), []
    for i in range(60):
        words = text(260, 50 + i).split()[:240] if i % 3 else text(20, 50 + i).split()[: 8 + i % 5]
        docs.append(" ".join(words))
        for n in range(1, 7):  # replaced from the end, so that similarity passes 0.8 slowly
            cut = max(1, len(words) * n // 40)
            docs.append(" ".join([*words[:-cut], *(f"w{draw.random()}" for _ in range(cut))]))
            docs.append(" ".join([*words, *(f"w{draw.random()}" for _ in range(2 * cut))]))
    docs += ["again " * 40 + " ".join(text(30, i).split()[:9]) for i in range(5)]  # counts are alike, sets are not
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in docs]
    plain = Groups(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                plain.join(a, b)
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in simhash.near_groups(table, simhash.LONG).collect()}
    wanted = {}
    for i in range(len(docs)):
        wanted.setdefault(plain.top(i), i)
    assert found == {i: wanted[plain.top(i)] for i in range(len(docs))}
    assert 60 < len(set(found.values())) < len(docs) - 60


@pytest.mark.parametrize("dense", [1, 200, 1 << 40])
def test_candidates_of_a_shard_are_the_nearest_and_lowest_without_walking_a_tree(monkeypatch, dense):
    draw, plan = np.random.default_rng(5), simhash.LONG
    sketches = draw.integers(0, 1 << 64, (3000, plan.words), dtype=np.uint64)
    for i in range(1000, 2000):  # some bits of an earlier one
        sketches[i] = sketches[draw.integers(i)]
        for bit in draw.choice(512, draw.integers(0, 130), replace=False):
            sketches[i, bit >> 6] ^= np.uint64(1) << np.uint64(bit & 63)
    sketches[2000:2200, 0] &= np.uint64((1 << 40) - 1)  # one value of the band for many
    nodes = draw.permutation(3000) - 1500
    roots = np.where(draw.random(3000) < 0.5, nodes, 7)
    asks = draw.random(3000) < 0.3
    values, likely = plan.band(sketches, 0), simhash.bits_for(plan.similarity, 512)
    wanted = set()
    for part in (np.flatnonzero(asks), np.flatnonzero(~asks)):  # homes ask their own shard as well
        for i in part:
            far = np.bitwise_count(sketches[i] ^ sketches).sum(axis=1, dtype=int)
            near = ~asks & (roots != roots[i]) & (np.bitwise_count(values[i] ^ values) <= 1) & (far <= plan.most)
            if near.any():
                wanted.add((nodes[i], min(zip(far[near], nodes[near]))[1]))
            if (near & (far <= likely)).any():
                wanted.add((nodes[i], nodes[near & (far <= likely)].min()))
    compared, count = [], np.bitwise_count
    monkeypatch.setattr(simhash, "DENSE", dense, raising=False)
    monkeypatch.setattr(np, "bitwise_count", lambda x, *more: compared.append(x.size) or count(x, *more))
    shard = simhash.Candidates((0, 0), plan, 0)
    found = [*shard.found(asks, nodes, sketches, roots), *shard.ended()]
    assert {(a, b) for side in found for a, b in zip(*side, strict=True)} == wanted and len(wanted) > 300
    assert sum(compared) < 400_000  # numbers whose bits were counted; more than a million in a tree


def test_a_family_just_below_the_similarity_is_not_decided_pair_by_pair(spark, monkeypatch):
    draw, docs = random.Random(13), []
    base = text(190, 77).split()[:180]
    for i in range(210):
        found = list(base)
        for at in draw.sample(range(172), 2 if i < 150 else 1):  # from 150 on copies with one other word
            for n in range(7 if i < 150 else 1):
                found[at + n] = f"w{draw.random()}"
        docs.append(" ".join(found))
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in docs]
    plain = Groups(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                plain.join(max(plain.top(a), plain.top(b)), min(plain.top(a), plain.top(b)))
    decided, write = [], simhash.written

    def counted(df, purpose):
        found = write(df, purpose)
        if purpose == "candidates":
            decided.append(found.count())
        return found

    monkeypatch.setattr(simhash, "written", counted)
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in simhash.near_groups(table, simhash.LONG).collect()}
    assert found == {i: plain.top(i) for i in range(len(docs))}
    assert len(set(found.values())) > 100 and found[150] == found[209]
    assert len(decided) == 2 and decided[1] < 2 * len(docs)  # the family has some 20,000 pairs


def test_pairs_that_meet_by_rare_shingles_hold_all_similar_ones(spark):
    draw, sets = random.Random(17), []
    for i in range(240):
        if i % 3 == 0:
            pool = draw.sample(range(1 << 62, (1 << 62) + 60), 40) if i % 2 else [draw.getrandbits(64) for _ in range(40)]
            sets.append(pool[: draw.randrange(1, 40)])
        else:  # some taken out, some put in
            of = sets[i - i % 3]
            sets.append(draw.sample(of, max(1, len(of) - draw.randrange(4))) + [draw.getrandbits(64) for _ in range(draw.randrange(3))])
    roots = [draw.randrange(40) - 20 if draw.random() < 0.6 else 7 for _ in sets]
    table = spark.createDataFrame(
        [(n - 100, r, [x - (x >> 63 << 64) for x in sorted(s)]) for n, (r, s) in enumerate(zip(roots, sets))]
        + [(1000, 50, []), (1001, 51, [])], "node long, root long, shingles array<long>",
    )
    found = [(r.a + 100, r.b + 100) for r in simhash.may_be_similar(table, simhash.LONG).collect()]
    alike = {
        (a, b) for b in range(len(sets)) for a in range(b)
        if roots[a] != roots[b] and len({*sets[a]} & {*sets[b]}) >= 0.8 * len({*sets[a]} | {*sets[b]})
    }
    assert len(found) == len(set(found)) and all(a < b and roots[a] != roots[b] for a, b in found)
    assert alike <= set(found) and 40 < len(alike)
    assert simhash.may_be_similar(table.limit(0), simhash.LONG).isEmpty()


def _distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def _edit(one, draw, times, letters="abc"):
    found = list(one)
    for _ in range(times):
        at = draw.randrange(len(found) + 1)
        kind = draw.randrange(3)
        if kind == 0:
            found.insert(at, draw.choice(letters))
        elif found:
            found[min(at, len(found) - 1)] = draw.choice(letters) if kind == 1 else ""
    return "".join(found)


def test_banded_distance_and_segments():
    draw = random.Random(1)
    for _ in range(5000):
        a = "".join(draw.choice("abc") for _ in range(draw.randrange(16)))
        b = _edit(a, draw, draw.randrange(5))
        most = draw.randrange(4)
        far = _distance(a, b)
        assert lines.within(a, b, most) == (far <= most)
        assert lines.within("x" + a, "x" + b, most) == (far <= most)
        a, b = "a" * 7 + a + "b", "a" * 7 + b + "b"
        if 0 < far <= lines.edits(min(len(a), len(b))):
            short, long = sorted((a, b), key=len)
            index = {(len(short), i, short[p : p + n]) for i, (p, n) in enumerate(lines.segments(len(short)))}
            assert index & {(n, i, long[p : p + z]) for n, i, p, z in lines.probes(len(long))}
            x, y = lines.signatures([s.encode("utf-32-le") for s in (a, b)]).view(np.uint64)
            assert int(x ^ y).bit_count() <= 4 * lines.EDITS


def _line_documents(spark):
    draw = random.Random(8)
    base = [" ".join(text(12, i).split()) for i in range(25)]
    near = [_edit(b, draw, draw.randrange(1, 4), "abé ") for b in base for _ in range(4)]
    many = base + near
    draw.shuffle(many)
    docs = [(i, "\n".join(many[5 * i : 5 * i + 5]) + f"\nshort line {i}\nand") for i in range(25)]
    docs += [(50, base[0] + "\n  " + base[0] + " \nown words of this one"), (51, base[0]), (51, base[0]), (None, base[1]), (52, None), (53, ""), (54, "\n\n")]
    docs += [(60, "end " * 9 + "x" * 20_000)]
    return docs, spark.createDataFrame([(*d, "s", "a", 0) for d in docs], "doc_id long, text string, source string, line string, n_chars long")


@pytest.mark.parametrize("hot", [4096, 2])
def test_line_classes_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(lines, "HOT", hot)
    docs, table = _line_documents(spark)
    where = {}
    for i, t in docs:
        for n, line in enumerate((t or "").split("\n")):
            if len(WORD.findall(line)) >= lines.LEAST_WORDS:
                where[i, n] = line.strip(lines.BLANKS)
    different = sorted(set(where.values()))
    plain, degree = Groups(different), Counter()
    for n, a in enumerate(different):
        for b in different[:n]:
            if abs(len(a) - len(b)) <= 2 and _distance(a, b) <= 2:
                plain.join(a, b)
                degree.update((a, b))
    found = lines.classes(table).collect()
    assert {(r.doc_id, r.line_no) for r in found} == set(where)
    first, ids = {}, {}
    for key in sorted(where, key=lambda k: (k[0] is None, k[0] or 0, k[1])):
        first.setdefault(plain.top(where[key]), key)
    for r in found:
        top = plain.top(where[r.doc_id, r.line_no])
        assert r.n_links == degree[where[r.doc_id, r.line_no]]
        assert r.is_first == (first[top] == (r.doc_id, r.line_no))
        assert ids.setdefault(top, r.class_id) == r.class_id
    assert len(set(ids.values())) == len(ids) and sum(degree.values()) > 40

    out = lines.without_repeats(table)
    assert out.columns == table.columns
    left = {r.doc_id: r.text for r in out.collect() if r.doc_id != 51}
    for i, t in docs:
        kept = [x for n, x in enumerate((t or "").split("\n")) if (i, n) not in where or first[plain.top(where[i, n])] == (i, n)]
        same = len(kept) == len((t or "").split("\n"))
        if i != 51 and (same or any(WORD.search(x) for x in kept)):
            assert left.pop(i) == (t if same else "\n".join(kept))
    assert not left


def test_short_lines_have_classes_and_copies_go_whole(spark, folder):
    own = [" ".join(text(12, 900 + i).split()) for i in range(4)]
    poem = "\n".join("seven words of line number %d here" % n for n in (1, 22, 333, 4444, 55555, 6666666, 77777777, 888888888))
    docs = [
        (1, f"{own[0]}\nTitle\n\nLicensed under the one license.\nab"), (2, f"{own[0]}\nTitle\n\nLicensed under the one license.\nab"),
        (3, f"{own[1]}\nLicensed under the one license.\n{own[2]}\nab"), (4, poem), (5, f"{own[3]}\n{poem}\nend of five"),
        (6, "一行没有空格的文字写在这里"), (7, "一行没有空格的文字写在这里"), (8, "x\n \nNo. 1"), (9, "y\nNo. 2"),
    ]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    table.write.parquet(f"{folder}/documents.parquet")
    found = {(r.doc_id, r.line_no): r for r in queries.op6_line_dedup(spark, folder).collect()}
    assert set(found) == {(i, n) for i, t in docs for n, x in enumerate(t.split("\n")) if WORD.search(x)}
    assert found[6, 0].class_id == found[7, 0].class_id and found[6, 0].is_first and not found[7, 0].is_first
    assert found[8, 2].class_id != found[9, 1].class_id and found[8, 2].n_links == 0  # five characters
    assert found[8, 0].class_id != found[9, 0].class_id and found[3, 3].class_id == found[1, 4].class_id
    left = {r.doc_id: r.text for r in lines.without_repeats(table, short=True).collect()}
    assert set(left) == {1, 3, 4, 5, 6, 7, 8, 9} and left[5] == f"{own[3]}\nend of five"
    assert all(left[i] == t for i, t in docs if i not in (2, 5))


def test_classes_of_short_lines_against_brute_force(spark):
    draw = random.Random(21)
    base = [_edit("", draw, 400, "abcdefgh ")[:n].strip() + "x" for n in range(1, 40) for _ in range(2)]
    many = base + [_edit(b, draw, draw.randrange(1, 4), "abé ") for b in base for _ in range(3)]
    docs = [(i, "\n".join(many[4 * i : 4 * i + 4])) for i in range(len(many) // 4)]
    where = {(i, n): x.strip(lines.BLANKS) for i, t in docs for n, x in enumerate(t.split("\n")) if WORD.search(x)}
    different = sorted(set(where.values()))
    plain, degree = Groups(different), Counter()
    for n, a in enumerate(different):
        for b in different[:n]:
            if abs(len(a) - len(b)) <= 2 and _distance(a, b) <= sum(min(len(a), len(b)) >= x for x in (12, 24)):
                plain.join(a, b)
                degree.update((a, b))
    assert len({len(a) < 12 for a in degree}) == 1 and sum(12 <= len(a) < 24 for a in degree) > 5
    ids = {}
    found = lines.classes(spark.createDataFrame(docs, "doc_id long, text string"), short=True).collect()
    assert {(r.doc_id, r.line_no) for r in found} == set(where)
    for r in found:
        line = where[r.doc_id, r.line_no]
        assert r.n_links == degree[line] and ids.setdefault(plain.top(line), r.class_id) == r.class_id
    assert len(set(ids.values())) == len(ids)
    odd = lines.classes(odd_documents(spark), short=True)
    assert odd.where("doc_id IN (300, 301, 302)").isEmpty() and odd.where("doc_id = 307").count() == 1
    assert odd.where("doc_id IS NULL").count() > 1


def test_near_copies_go_although_lines_were_taken_out(spark, folder):
    draw = random.Random(6)
    whole = [text(360, 40 + i) for i in range(12)]
    near = []
    for t in whole:
        found = t.split(" ")
        for at in draw.sample(range(len(found)), 3):
            found[at] = f"other{draw.randrange(10**6)}"
        near.append(" ".join(found))
    docs = spark.createDataFrame(list(enumerate(whole + near)) + [(99, text(80, 5))], "doc_id long, text string")
    docs.write.parquet(f"{folder}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    lined = stage["line_dedup"](spark, docs, folder)
    assert lined.where("doc_id BETWEEN 12 AND 23").count() == 12  # fragments are left of the copies
    assert {r.doc_id for r in stage["simhash"](spark, lined, folder).collect()} == {*range(12), 99}


def test_lines_without_documents(spark):
    assert lines.classes(no_documents(spark)).count() == 0
    assert lines.without_repeats(no_documents(spark)).count() == 0
    odd = odd_documents(spark)
    assert lines.without_repeats(odd).columns == odd.columns


def _corpus(spark, folder):
    """Documents with planted toxic ones, copies and a passage that many share."""
    passage = " ".join(text(60, 4242).split())
    clean = [(i, text(80, i)) for i in range(300)]
    toxic = [(1000 + i, text(30, 2000 + i) + " vile creature " + text(9, 3000 + i) + " vile scoundrel vile pest") for i in range(90)]
    copies = [(5000 + i, clean[0][1]) for i in range(3)]
    shared = [(6000 + i, text(40, 7000 + i) + "\n" + passage + "\n" + text(40, 8000 + i)) for i in range(4)]
    every = clean + toxic + copies + shared
    docs = spark.createDataFrame(
        [(i, t, "en", f"s{i % 2}", len(t)) for i, t in every], "doc_id long, text string, lang string, source string, n_chars long"
    )
    labels = spark.createDataFrame([(i, 1, int(1000 <= i < 2000)) for i, _ in every], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return passage


def test_pipeline_stages(spark, folder):
    passage = _corpus(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "mixing", "sentencepiece"]

    def ids(df):
        return {r.doc_id for r in df.select("doc_id").collect()}

    calm = stage["toxicity"](spark, docs, folder)
    assert ids(calm) == ids(docs.where("doc_id < 1000 OR doc_id >= 2000")) and calm.columns == docs.columns
    lined = stage["line_dedup"](spark, docs, folder)
    assert [r.doc_id for r in lined.where(F.contains("text", F.lit(passage))).collect()] == [6000]
    assert set(range(300)) | set(range(6000, 6004)) <= ids(lined) and not {5000, 5001, 5002} & ids(lined)
    single = stage["simhash"](spark, docs, folder)
    assert ids(docs) - ids(single) == {5000, 5001, 5002} and single.count() == docs.count() - 3
    whole = corpus_pipeline.run(spark, folder)
    step = docs
    for _, work in corpus_pipeline.STAGES:
        step = work(spark, step, folder)
    assert sorted(map(str, whole.collect())) == sorted(map(str, step.collect()))
    assert whole.where("NOT round_trip").count() == 0 and whole.where("doc_id >= 1000 AND doc_id < 2000").count() == 0


@pytest.mark.parametrize("make", [odd_documents, no_documents])
def test_pipeline_stages_take_odd_and_empty_tables(spark, folder, make):
    docs = make(spark)
    docs.write.parquet(f"{folder}/documents.parquet")
    odd_documents(spark).select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{folder}/labels.parquet")
    step = docs
    for name, work in corpus_pipeline.STAGES:
        step = work(spark, step, folder)
        if name != "sentencepiece":
            assert step.columns == docs.columns
    assert (step.count() > 20) == (docs.count() > 0)


def test_toxicity_keeps_columns(spark):
    model = toxicity.Model({}, slope=0.0)
    out = toxicity.score(odd_documents(spark), model, prefix="x_")
    assert out.columns == [*odd_documents(spark).columns, "x_score", "x_predicted", "x_passages"]


def test_runs_of_lines_are_sought_once_in_a_task(spark):
    docs = spark.createDataFrame(
        [(i, f"good day to you\nall the best from here\nown line number {i}") for i in range(3)], "doc_id long, text string"
    )
    found = lines.without_repeats(docs, short=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # A second call is a second Python process in each task.
    assert plan.count("ArrowEvalPython") == 1
    texts = {r.doc_id: r.text for r in found.collect()}
    assert texts == {
        0: docs.where("doc_id = 0").first().text, 1: "own line number 1", 2: "own line number 2"
    }


def test_sketches_are_made_of_a_slice_of_texts_at_a_time(spark, monkeypatch):
    def few(batch, column="text"):
        assert batch.num_rows <= 512
        return [x or "" for x in batch.column(column).to_pylist()]

    monkeypatch.setattr(simhash, "texts", few)
    docs = spark.range(1500).selectExpr("id AS doc_id", "concat('one two three four five ', id) AS text").coalesce(1)
    found = simhash.sketched(docs, simhash.LONG).collect()
    assert {r.doc_id for r in found} == set(range(1500)) and len({r.node for r in found}) == len(found)
