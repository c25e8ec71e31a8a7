"""Importance resampling, spelling variants and personal data."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import no_documents, odd_documents, rows
from pyspark.sql import functions as F

from inkspan.llm import pii, queries, resampling, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text):
    words = WORDS.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def _resampled(docs, target):
    """Plain version: (doc_id, n_features, weight, score, rank) of every row."""
    def buckets(features):
        return [zlib.crc32(f.encode()) % 10_000 for f in features]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets(_features(text)[1]))
    for text in target:
        t.update(buckets(_features(text)[1]))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000)))) for b in s}
    found, able = [], []
    for doc_id, text in docs:
        n, features = _features(text)
        weight = sum(gain[b] for b in buckets(features))
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([doc_id, len(features), weight, score, None])
        able += [found[-1]] * (n >= 20)
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: len(able) * 5 // 100]):
        row[4] = place + 1
    return sorted((tuple(r) for r in found), key=str)


def _many(seed, n):
    """Documents whose lines repeat, are short, blank, or hold one word."""
    draw = random.Random(seed)
    lines = [" ".join(draw.choice(["the", "Of", "stone", "ÉCOLE", "x1", "日本", "a-b"]) for _ in range(draw.randrange(7))) for _ in range(40)]
    return [(i, "\n".join(draw.choice(lines) for _ in range(draw.randrange(25)))) for i in range(n)]


def test_resampling_against_plain_python(spark):
    docs = _many(1, 120) + [(i, t) for i, t, *_ in rows() if i != 306]
    target = [t for _, t in _many(2, 9)] + [None, ""]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("line", F.lit(1)).withColumn("rank", F.lit("x"))
    found = resampling.resample(table.repartition(5), spark.createDataFrame([(t,) for t in target], "text string"))
    assert dict(found.dtypes) == {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"}
    ours = [tuple(r) for r in found.collect()]
    wanted = _resampled(docs, target)
    assert sorted((r[:4] for r in ours), key=str) == sorted((r[:4] for r in wanted), key=str)
    drawn = sorted(r[4] for r in ours if r[4])
    assert drawn == list(range(1, len(drawn) + 1)) == sorted(r[4] for r in wanted if r[4])
    # Rows of the same id and score may change places.
    assert sorted((r[4], r[0], r[3]) for r in ours if r[4]) == sorted((r[4], r[0], r[3]) for r in wanted if r[4])


def test_line_and_crossing_features_are_those_of_the_text():
    for _, text in _many(3, 200):
        lines = [w for line in text.encode().split(b"\n") if (w := resampling.words_of(line))]
        split = [b for line in lines for b in resampling.line_features(line)] + resampling.crossing_features(lines)
        assert Counter(split) == Counter(zlib.crc32(f.encode()) % 10_000 for f in _features(text)[1])


def test_resampling_of_hot_lines_and_empty_tables(spark, monkeypatch):
    docs = [(i, "a common line of many words here\n" * (i % 4) + f"own words {i} of this text " * 4) for i in range(60)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    target = spark.createDataFrame([("own words of a text",)], "text string")
    wanted = _resampled(docs, ["own words of a text"])
    for share in (1000, 5, 1):  # all lines hot, one, none
        monkeypatch.setattr(resampling, "HOT_SHARE", share)
        assert sorted((tuple(r) for r in resampling.resample(table, target).collect()), key=str) == wanted
    assert resampling.resample(no_documents(spark), target).count() == 0
    alone = resampling.resample(table, target.limit(0)).collect()
    assert sorted((tuple(r) for r in alone), key=str) == _resampled(docs, [])


def test_order_without_one_task(spark):
    draw = random.Random(4)
    values = [(draw.randrange(20), i) for i in range(500)]
    placed = resampling.ordered(spark.createDataFrame(values, "a long, b long"), [F.desc("a"), F.asc("b")])
    order = sorted(values, key=lambda v: (-v[0], v[1]))
    assert [(r.a, r.b) for r in sorted(placed.collect(), key=lambda r: r.place)] == order
    assert sorted(r.place for r in placed.collect()) == list(range(1, 501))


RUNS = re.compile("[A-Za-zÀ-ÿ]+")


def _spelled(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in RUNS.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if x != w and _one_edit(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _misspelled(seed):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcé") for _ in range(draw.randrange(4, 11))) for _ in range(60)]
    words += [w[:i] + draw.choice("abcé") + w[i + draw.randrange(2) :] for w in words for i in (0, len(w) // 2, len(w))]
    words += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "É" * 5, "é" * 5, "ÿÿÿÿÿ×"]
    weights = [draw.choice([1, 4, 16]) for _ in words[:-6]] + [5, 25, 125, 9, 9, 9]
    return [(i if i else None, " ".join(draw.choices(words, weights, k=80)) + "1" + draw.choice(words)) for i in range(60)]


@pytest.mark.parametrize("block", [2048, 3])
def test_spelling_variants_against_plain_python(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "CELLS", 64 if block == 3 else 1 << 21)
    docs = _misspelled(block)
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("w")).withColumn("n", F.lit("n"))
    found = sorted(tuple(r) for r in spelling.group(table).select("word", "form", "root", "n", "n_near", "form_n").collect())
    wanted = _spelled(docs)
    assert found == wanted
    assert sum(r[4] for r in wanted) > 100 and any(r[1] and r[2] != r[1] for r in wanted)


def test_spelling_of_odd_and_empty_tables(spark):
    found = spelling.group(odd_documents(spark)).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(tuple(r) for r in found) == _spelled([(i, t) for i, t, *_ in rows()])
    assert spelling.group(no_documents(spark)).count() == 0


def test_roots_of_long_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)]
    found = spelling.roots(spark.createDataFrame(chain, "word string, root string")).collect()
    assert {r.root for r in found} == {"w37"} and len(found) == 37


def test_tiles_find_single_edits_only():
    draw = np.random.default_rng(6)
    words = sorted({"".join(draw.choice(list("ab"), size=n)) for n in (6, 7, 8) for _ in range(40)})
    found = set()
    for longer in (6, 7, 8):
        for side in (0, 1):
            keys = defaultdict(list)
            for w in words:
                if len(w) in (longer, longer - 1):
                    keys[w[: longer // 2] if side == 0 else w[len(w) - (longer - longer // 2) :]].append(w)
            for group in keys.values():
                pairs = [tuple(sorted(p)) for p in spelling._one_edit(group, group, longer, side)]
                assert len(pairs) == len(set(pairs)) and not found & set(pairs)
                found |= set(pairs)
    assert found == {(a, b) for a in words for b in words if a < b and _one_edit(a, b)}


def _personal(text):
    """Plain version of the base kinds: kind -> spans."""
    found = {}
    found["email"] = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found["ip"] = [
        m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))
    ]
    found["card"] = []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        twice = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(twice) % 10 == 0:
            found["card"].append(m.span())
    found["phone"] = [
        m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15
    ]
    return found


def test_base_spans_of_random_texts():
    draw = random.Random(13)
    parts = [
        "a@b.c", "x.y@", "@", ".", "-", "1.2.3.4", "256.1.1.1", "007.8.9.10.11", "4111 1111 1111 1111", "4111111111111112",
        "+1 (555) 123-4567", "+49", " ", "é", "1", "99", "+", "(", ")", "_", "%", "a", "\n", "mail", "١٢",
    ]
    hits = Counter()
    for _ in range(4000):
        text = "".join(draw.choices(parts, k=draw.randrange(12)))
        ours, wanted = defaultdict(list), _personal(text)
        for s in pii.spans(text):
            ours[s["kind"]].append((s["start"], s["stop"]))
            assert s["text"] == text[s["start"] : s["stop"]]
        for kind, spans in wanted.items():
            assert ours[kind] == spans, (kind, text)
            hits[kind] += len(spans)
    assert min(hits.values()) > 100


def test_checksums_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod_97("GB82WEST12345698765432") and not pii.mod_97("GB82WEST12345698765433")
    kinds = lambda text: [(s["kind"], s["score"]) for s in pii.spans(text)]
    assert kinds("my bank: GB82 WEST 1234 5698 7654 32.") == [("iban", 1.0)]
    assert kinds("xx DE89370400440532013000 yy") == [("iban", 0.7)] and kinds("DE89370400440532013001") == []
    assert kinds("ref 123-45-6789") == [] and kinds("SSN 123-45-6789") == [("ssn", 0.6)]
    assert kinds("ssn 000-45-6789, 666-45-6789, 912-45-6789") == []
    assert kinds("call +1 (555) 123-4567") == [("phone", 0.9)] and kinds("to +1 (555) 123-4567") == [("phone", 0.6)]
    assert kinds("call " + "x" * 50 + " +1 (555) 123-4567") == [("phone", 0.6)]


def test_long_texts_take_linear_time():
    n = 300_000
    for text in ("a" * n, "1" * n, "1." * n, "a@" * n, "+1" * n, "a" * n + "@" + "b" * n, "+" + "1-" * n, "A1" * n, "1 " * n):
        pii.spans(text)


def test_personal_data_of_tables(spark, folder):
    odd_documents(spark).write.parquet(f"{folder}/documents.parquet")
    found = queries.op13_personal_data(spark, folder).collect()
    assert len(found) == len(rows()) and all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in found if not r.spans)
    assert pii.digest(pii.find(no_documents(spark))).count() == 0
    text = "mail a@b.cd, 10.0.0.1 or IBAN DE89370400440532013000 é +1 555 123 4567"
    table = spark.createDataFrame([(None, text), (1, None)], "doc_id long, text string")
    row, = pii.digest(pii.find(table)).where("doc_id IS NULL").collect()
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 0, 1)
    listed = ",".join(f"{k}:{a}:{b}" for k, spans in _personal(text).items() for a, b in spans)
    assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and row.spans == listed + ",iban:30:52"
    masked = table.join(pii.find(table).where("doc_id IS NULL"), F.lit(True)).where("text IS NOT NULL")
    assert masked.select(pii.masked(masked, F.col("spans"))).first()[0] == "mail [email], [ip] or IBAN [iban] é [phone]"
