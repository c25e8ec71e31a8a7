"""Languages, toxicity, quality rules, fingerprints and pieces."""

import hashlib
import itertools
import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from llm_data import no_documents, odd_documents, rows, text
from pyspark.sql import functions as F

from inkspan.llm import fingerprints, language, pieces, quality, queries, toxicity

SF = "/root/testdata/sf0.01"
data = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


def _plain_vector(text):
    found = np.zeros(language.DIMENSIONS)
    low = "".join(c.lower() if c.isalpha() else " " for c in text)
    points = [0, *(ord(c) if c != " " else 0 for c in low), 0]
    for a, b, c in zip(points, points[1:], points[2:]):
        if b:
            found += language.letter_vector(a).astype(int) * np.roll(language.letter_vector(b), 1) * np.roll(language.letter_vector(c), 2)
    return found


def test_text_vectors_are_bundles_of_bound_letters():
    many = ["Hello, wörld x", "", "日本 abc", "a"]
    grams, counts = language.count_grams(many)
    got = language.bundle(grams, counts)
    for text_, vector in zip(many, got):
        assert np.array_equal(vector, _plain_vector(text_))


@data
def test_language_held_out(spark):
    found = queries.op2_language_id(spark, SF).join(spark.read.parquet(SF + "/documents.parquet").select("doc_id", "lang"), "doc_id")
    hits = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert hits > 0.98
    assert found.where("score < 0 OR score > 1 OR lang_pred IS NULL").count() == 0


def test_language_odd_rows(spark):
    docs = odd_documents(spark)
    prototypes = language.train(docs)
    assert prototypes.languages == ("de", "en")
    found = language.identify(docs, prototypes).collect()
    assert len(found) == len(rows())
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (300, 301, 302, 303))
    assert by_id[304].lang_pred in ("de", "en") and by_id[305].lang_pred in ("de", "en")
    assert language.identify(no_documents(spark), prototypes).count() == 0
    none = language.train(no_documents(spark))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}


def _all_segments(values):
    """Maximal segments by their recursive definition: the best one, then what is left and right of it."""
    if not any(v > 0 for v in values):
        return []
    total = [0, *itertools.accumulate(values)]
    best = max(((total[j] - total[i], -(j - i), -i, i, j) for i in range(len(values)) for j in range(i + 1, len(values) + 1)))
    i, j = best[3], best[4]
    left = _all_segments(values[:i])
    right = [(s, a + j, b + j) for s, a, b in _all_segments(values[j:])]
    return left + [(best[0], i, j)] + right


def test_segments_against_the_definition():
    draw = random.Random(5)
    for _ in range(300):
        words = [draw.choice(["good", "bad", "awful", "plain", "nice"]) for _ in range(draw.randrange(0, 25))]
        scores = toxicity.Scores({"bad": (1.75, 9.0), "awful": (3.0, 9.0), "nice": (-1.25, 9.0)})
        values = [(scores[w] or 0) - toxicity.DRIFT for w in words]
        got = toxicity.segments(words, scores)
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in _all_segments(values)]
        assert np.allclose([s for s, *_ in got], [s for s, *_ in _all_segments(values)])


@data
def test_toxicity_held_out(spark):
    found = queries.op8_toxicity(spark, SF).join(spark.read.parquet(SF + "/labels.parquet"), "doc_id").where("held_out").toPandas()
    toxic, clean = found[found.toxic == 1], found[found.toxic == 0]
    assert toxic.predicted.mean() > 0.6 and clean.predicted.mean() < 0.03
    assert found.score.between(0, 1).all() and ((found.score >= 0.7) == (found.predicted == 1)).all()


def _labelled(spark):
    plain = [(i, text(40, i), 0) for i in range(200)]
    nasty = [(1000 + i, text(20, 500 + i) + " vile creature " + text(8, 900 + i) + " vile scoundrel", 1) for i in range(60)]
    docs = spark.createDataFrame(plain + nasty, "doc_id long, text string, toxic int")
    return docs.select("doc_id", "text"), docs.select("doc_id", "toxic")


def test_toxic_passages_and_odd_rows(spark):
    docs, labels = _labelled(spark)
    odd = spark.createDataFrame([(None, 1), (3, None), (1001, 1), (1001, 0), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.train(toxicity.labelled(docs, labels.unionByName(odd)))
    scored = toxicity.score(docs, model).collect()
    assert all(r.predicted == (r.doc_id >= 1000) for r in scored)
    one = next(r for r in scored if r.doc_id == 1000)
    assert any("vile" in one.text[p.start : p.end] and p.expected <= toxicity.MOST_EXPECTED for p in one.passages)
    with pytest.raises(ValueError):
        toxicity.score(odd_documents(spark), model)  # it has a column score
    found = toxicity.score(odd_documents(spark), model, prefix="t_").collect()
    assert len(found) == len(rows()) and not any(r.t_predicted for r in found)
    assert {r.t_score for r in found if r.doc_id in (300, 301, 302, 303)} == {min(r.t_score for r in found)}
    assert toxicity.score(no_documents(spark), model, prefix="t_").count() == 0


def test_no_labels_reject_nothing(spark):
    docs, labels = _labelled(spark)
    model = toxicity.train(toxicity.labelled(docs, labels.limit(0)))
    assert {r.predicted for r in toxicity.score(docs, model).collect()} == {0}


def _measure(text):
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(quality.BLANKS)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + o for i, w in enumerate(windows) if windows.count(w) > 1 for o in range(5)}
    return (
        len(words), sum(len(w.decode()) for w in words), sum(c in quality.SYMBOLS for c in text), len(lines),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(inside),
    )


def test_quality_measures_and_ledger(spark):
    small = [t or "" for _, t, *_ in rows() if len(t or "") < 5000] + ["a b c d e " * 4, "x\ny\nx\n \nx", "# $ % & | < > *"]
    for one in small:
        assert quality.measure(one) == _measure(one)
    found = quality.ledger(odd_documents(spark))
    assert found.count() == len(rows())
    for r in found.collect():
        for name, rule in quality.RULES.items():
            assert bool(r.failures & quality.BITS[name]) == eval(rule, {c: r[c] for c in quality.MEASURES})
    assert quality.ledger(no_documents(spark)).count() == 0


def test_policies_and_ablations(spark):
    found = quality.ledger(odd_documents(spark))
    bits = [r.failures for r in found.collect()]
    policy = quality.POLICIES["v2"]
    assert quality.apply_policy(found, "v2").where("kept").count() == sum(not b & policy for b in bits)
    rows_ = {r.rule: r for r in quality.ablations(found, "v2").collect()}
    for name, bit in quality.BITS.items():
        assert rows_[name].n_rejected == sum(bool(b & bit) for b in bits)
        assert rows_[name].n_only == sum(b & policy == bit for b in bits)
        assert rows_[name].n_kept_without == sum(not b & policy & ~bit for b in bits)


def _jaccard(a, b):
    a, b = (Counter(x.encode().lower().split()) for x in (a, b))
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_collision_rate_is_generalised_jaccard():
    errors = []
    for seed in range(60):
        a, b = text(120, seed), text(60, seed) + " " + text(60, 1000 + seed) + " the the the"
        errors.append(fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b)) - _jaccard(a, b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


@pytest.mark.parametrize("shared", [0, 5_000, 10_000])
def test_collision_rate_of_texts_of_many_words(shared):
    found = []
    for other in range(10):
        # Shared words stand once in one text and twice in the other.
        one = [f"a{other}x{i}" for i in range(20_000)]
        two = one[:shared] * 2 + [f"b{other}x{i}" for i in range(20_000 - shared)]
        a, b = " ".join(one), " ".join(two)
        found.append(fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b)) - _jaccard(a, b))
    assert abs(np.mean(found)) < 0.04 and (shared or max(found) < 0.02)


def test_variables_follow_their_laws():
    words = np.random.default_rng(5).integers(0, 1 << 64, 3000, np.uint64)
    r, log_c, b = fingerprints._variables(words, fingerprints._drawn(words, 0))
    c = np.exp(log_c)
    for gamma in (r, c):  # of shape 2: mean 2, variance 2
        assert abs(gamma.mean() - 2) < 0.02 and abs(gamma.var() - 2) < 0.08
        assert abs((gamma < 1).mean() - (1 - 2 / np.e)) < 0.005
    assert abs(b.mean() - 1 / 2) < 0.005 and abs(b.var() - 1 / 12) < 0.002 and 0 <= b.min() and b.max() <= 1
    among = np.corrcoef(np.stack([r.ravel(), c.ravel(), b.ravel()]))
    assert np.abs(among - np.eye(3)).max() < 0.01
    assert np.abs(np.corrcoef(r.T) - np.eye(fingerprints.SAMPLES)).max() < 0.12  # positions are independent


def test_weighted_draws_against_the_formula():
    words, weights = np.array([3, 17, 900], np.uint64), np.array([1, 2, 5], np.float32)
    r, log_c, b = fingerprints._variables(words, fingerprints._drawn(words, 0))
    t = np.floor(np.log(weights)[:, None] / r + b)
    y = np.exp(r * (t - b))
    drawn = (log_c - np.log(y * np.exp(r))).argmin(0)
    one, other = fingerprints._draw(words, weights), fingerprints._draw(words[::-1].copy(), weights[::-1].copy())
    assert np.array_equal(one, other)
    marks = {(d, int(t[d, i])): m for i, (d, m) in enumerate(zip(drawn, one))}
    assert all(marks[d, int(t[d, i])] == m for i, (d, m) in enumerate(zip(drawn, one)))
    assert len(set(marks.values())) == len(marks)


@pytest.mark.parametrize("size", [4096, 3, 1])
def test_edited_pairs_in_blocks_of_any_size(spark, monkeypatch, size):
    docs = [(i, t or "") for i, t, *_ in rows() if i is not None]
    ids = sorted({i for i, _ in docs}, reverse=True)
    monkeypatch.setattr(fingerprints.blocks, "__defaults__", (size, 1 << 16))
    found = fingerprints.with_edited(odd_documents(spark).where("doc_id IS NOT NULL")).collect()
    assert len(found) == len(docs)
    once = {i: t for i, t in docs if sum(j == i for j, _ in docs) == 1}
    marks = {i: fingerprints.fingerprint(t) for i, t in once.items()}
    checked = 0
    for r in found:
        after = ids[(ids.index(r.doc_id) + 1) % len(ids)]
        if r.doc_id in once and after in once:
            t, n = once[r.doc_id], once[after]
            third = len(t) // 3
            changed = t[: len(t) - third] + n[:third] if third else t
            assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
            assert r.fingerprint == fingerprints.hexed(marks[r.doc_id])
            assert r.near_next == fingerprints.likeness(marks[r.doc_id], marks[after])
            assert r.near_edited == fingerprints.likeness(marks[r.doc_id], fingerprints.fingerprint(changed))
            checked += 1
    assert checked > 30


@pytest.mark.parametrize("size", [4096, 8])
def test_fingerprints_of_odd_rows(spark, monkeypatch, size):
    monkeypatch.setattr(fingerprints.blocks, "__defaults__", (size, 1 << 16))
    found = fingerprints.with_edited(odd_documents(spark)).collect()
    assert len(found) == len(rows())
    assert {r.fingerprint for r in found if r.doc_id in (300, 301, 302)} == {fingerprints.EMPTY}
    assert fingerprints.with_edited(no_documents(spark)).count() == 0
    assert fingerprints.fingerprints(odd_documents(spark)).select("fingerprint").distinct().count() < len(rows())
    hot = spark.createDataFrame([(None, f"text number {i % 2} of two") for i in range(90)] + [(7, "a b c d e f")], "doc_id long, text string")
    found = fingerprints.with_edited(hot).collect()
    assert Counter(r.doc_id for r in found) == {None: 90, 7: 1} and Counter(r.near_next == 1 for r in found)[False] == 3
    alone = fingerprints.with_edited(odd_documents(spark).where("doc_id = 5")).first()
    assert alone.near_next == 1.0


TOY = ["▁", "a", "b", "ab", "aab", "▁a", "▁ab", "ba", "é", "▁▁", "abab"]


def _toy():
    names = TOY + [f"<0x{b:02X}>" for b in range(256)]
    scores = [-2.0, -2.5, -2.25, -3.0, -3.75, -3.0, -3.5, -3.25, -5.0, -3.0, -6.0] + [0.0] * 256
    return pieces.Vocabulary(names, scores, list(range(len(TOY))), list(range(len(TOY), len(names))))


def _best_score(text, vocabulary, unknown):
    """Over all ways to cut the text."""
    if not text:
        return 0.0
    found = [
        vocabulary.scores[i] + _best_score(text[len(vocabulary.pieces[i]) :], vocabulary, unknown)
        for i in vocabulary.normal if text.startswith(vocabulary.pieces[i])
    ]
    if text[0] not in [vocabulary.pieces[i] for i in vocabulary.normal]:
        found.append(unknown + _best_score(text[1:], vocabulary, unknown))
    return max(found)


def test_viterbi_is_the_best_of_all_segmentations():
    toy = pieces.Encoder(_toy())
    draw = random.Random(9)
    for _ in range(300):
        one = "".join(draw.choice("aabb é語") for _ in range(draw.randrange(1, 10)))
        marked = "▁" + one.replace(" ", "▁")
        ids = toy.encode(one).tolist()
        assert toy.decode(np.array(ids)) == one
        unknown = sum(c not in TOY for c in marked)
        score = sum(toy.vocabulary.scores[i] for i in ids) + unknown * toy.unknown
        assert math.isclose(score, _best_score(marked, toy.vocabulary, toy.unknown))
        assert ids == [i for p in toy.parts.findall(marked) for i in toy.best(p)]


def test_double_array_finds_all_prefixes():
    strings = {b"a": 0, b"ab": 1, b"abc": 2, b"b": 3, b"\xff": 4}
    trie = pieces.DoubleArray(strings)
    assert list(trie.prefixes(b"abcd", 0)) == [(1, 0), (2, 1), (3, 2)]
    assert list(trie.prefixes(b"zab", 1)) == [(2, 0), (3, 1)] and list(trie.prefixes(b"z\0", 0)) == []
    assert list(trie.prefixes(b"\xff\0", 0)) == [(1, 4)]


@pytest.mark.skipif(not Path(pieces.VOCABULARY).exists(), reason="no vocabulary")
def test_round_trip_of_odd_rows(spark):
    docs = odd_documents(spark)
    found = queries.tokenized(docs)
    assert found.columns == [*docs.columns, "piece_ids", "n_pieces", "round_trip"]
    out = found.collect()
    assert len(out) == len(rows()) and all(r.round_trip for r in out)
    assert {r.n_pieces for r in out if r.doc_id in (300, 301)} == {0}
    assert queries.tokenized(no_documents(spark)).count() == 0
    encoder = pieces.Encoder(pieces.Vocabulary.read(pieces.VOCABULARY))
    part = "▁" + "unsegmentable" * 20
    assert encoder.encode(part[1:]).tolist() == encoder.best(part)


@pytest.mark.skipif(not Path(pieces.VOCABULARY).exists(), reason="no vocabulary")
def test_pieces_and_their_text_come_from_one_python_process(spark):
    docs = odd_documents(spark)
    plan = queries.tokenized(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    vocabulary = pieces.Vocabulary.read(pieces.VOCABULARY)
    apart = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    together = pieces.encode_and_decode(docs, vocabulary)
    assert together.columns == apart.columns and sorted(map(repr, together.collect())) == sorted(map(repr, apart.collect()))
    with pytest.raises(ValueError):
        pieces.encode_and_decode(together, vocabulary, ids_col="other")
