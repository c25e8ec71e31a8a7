"""Toxicity by maximum-scoring segments of token log-odds.

Training compares in how many toxic and clean texts a word occurs. Its log-odds
have an informative Dirichlet prior, so a rare word stays near zero. All other
words cost a little, so a random text has a falling total. One linear scan finds
every maximal segment of a text. The best segment of a clean text of n words
follows an extreme-value law with tail K n exp(-lambda S); that law, fitted on
clean texts, says which segments are significant and how surprising all of them
are together. A logistic curve turns the surprise into the chance of the label.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.llm.common import SLICE, sent, texts, written

#: Labelled rows of each class that a model is fitted to: those of the smallest hash.
TRAINING_ROWS = 40_000
#: Strength of the prior, as a share of all counted words.
PRIOR = 0.05
#: A word counts if its log-odds are so many deviations from zero, and its score as far.
LEAST_Z, LEAST_SCORE = 2.0, 1.0
#: One for toxicity must be in so many toxic texts, after so many different words.
LEAST_TEXTS, LEAST_CONTEXTS = 3, 4
#: Times that a word of one text counts, so that a text that repeats itself proves little.
MOST_TIMES = 4
#: Lengths of the word beginnings that count beside whole words, marked by a hyphen.
STEMS = (5, 6, 7)
#: Words whose score a task remembers.
REMEMBERED = 1 << 16
#: What every word costs.
DRIFT = 0.5
#: Segments with a larger expected number in a clean text are no passages.
MOST_EXPECTED = 0.01
THRESHOLD = 0.7
TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str) -> list[str]:
    """The runs of letters, in lower case; their number is that of ``TOKEN`` matches."""
    found = TOKEN.findall(text)
    return "\n".join(found).lower().split("\n") if found else []


def features(word: str) -> list[str]:
    """What a word is known by: itself and its beginnings."""
    return [word, *(word[:n] + "-" for n in STEMS if len(word) >= n)]


class Scores(dict):
    """The score of a word, or None: that of its feature farthest from zero in deviations."""

    def __init__(self, known: dict[str, tuple[float, float]]):
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> float | None:
        if len(self) >= REMEMBERED:
            self.clear()
        found = [self.known[f] for f in features(word) if f in self.known]
        self[word] = score = max(found, key=lambda x: abs(x[1]))[0] if found else None
        return score


@dataclass(frozen=True)
class Model:
    known: dict[str, tuple[float, float]]  # log-odds and deviations of the features that count
    rate: float = 1.0  # lambda of the extreme-value law
    scale: float = 1.0  # its K
    slope: float = 1.0
    offset: float = -3.0


def segments(words: list[str], scores: Scores) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, start, end) of a text, in linear time.

    Words without a score cost ``DRIFT``, so only words with one are visited. A
    new piece joins earlier ones back to the last whose left total is smaller,
    as long as that raises the score; ``back`` leaps over pieces that cannot be it.
    """
    left: list[float] = []
    right: list[float] = []
    spans: list[tuple[int, int]] = []
    back: list[int] = []
    total, seen = 0.0, 0
    for at, word in enumerate(words):
        if (score := scores[word]) is None:
            continue
        total -= DRIFT * (at - seen)
        seen = at + 1
        before, total = total, total + score - DRIFT
        if total <= before:
            continue
        low, high, start = before, total, at
        j = len(left) - 1
        while True:
            while j >= 0 and left[j] >= low:
                j = back[j]
            if j < 0 or right[j] >= high:
                break
            low, start, previous = left[j], spans[j][0], back[j]
            del left[j:], right[j:], spans[j:], back[j:]
            j = previous
        left.append(low)
        right.append(high)
        spans.append((start, at + 1))
        back.append(j)
    return [(r - l, a, b) for l, r, (a, b) in zip(left, right, spans, strict=True)]


def expected(score: float, n: int, model: Model) -> float:
    """How many segments of this score a clean text of n words has."""
    return model.scale * max(n, 1) * math.exp(-min(model.rate * score, 700.0))


def surprise(found: list[tuple[float, int, int]], n: int, model: Model) -> float:
    """-log of the chance that a clean text has segments as high as these together."""
    if not found:
        return 0.0
    each = [expected(score, n, model) for score, *_ in found]
    high = [e for e in each if e <= MOST_EXPECTED]
    if not high:
        return -math.log(-math.expm1(-min(each))) if min(each) < 30 else 0.0
    total, r = -sum(map(math.log, high)), len(high)
    return max(0.0, total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r))


def chance(found: list[tuple[float, int, int]], n: int, model: Model) -> float:
    x = model.slope * math.log1p(surprise(found, n, model)) + model.offset
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def labelled(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", rows: int = TRAINING_ROWS,
) -> DataFrame:
    """text, toxic and fold of the rows to learn from: at most ``rows`` of each class.

    A document labelled twice is toxic if any label says so. Equal texts count
    once. The labels kept are bounded by a parameter, so they go to every task.
    """
    one = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("_labelled")
    ).agg((F.max(label_col) > 0).cast("int").alias("toxic"))
    hashed = one.withColumn("_order", F.xxhash64("_labelled"))

    def least(toxic: int) -> DataFrame:
        return hashed.where(F.col("toxic") == toxic).orderBy("_order", "_labelled").limit(rows)

    few = F.broadcast(least(0).unionByName(least(1)).select("_labelled", "toxic"))
    texts_of = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    met = texts_of.join(few, texts_of["_id"] == few["_labelled"]).select("text", "toxic")
    hashes = met.withColumn("_hash", F.xxhash64("text"))
    once = hashes.groupBy("_hash").agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    return once.select("text", "toxic", (F.pmod("_hash", F.lit(4)) == 0).alias("calibrates"))


def word_counts(rows: DataFrame) -> DataFrame:
    """How often a feature occurs in either class; in toxic texts, in how many and after how many words.

    The latter, counted in 63 classes of words, tells a word that toxic texts use
    from one of a text that has many near copies.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(texts(batch), batch.column("toxic").to_pylist(), strict=True):
                words = tokens(text)
                held = set()
                for word, times in Counter(words).items():
                    for feature in features(word):
                        found.setdefault(feature, [0, 0, 0, 0])[not toxic] += min(times, MOST_TIMES)
                        held.add(feature)
                if not toxic:
                    continue
                for feature in held:
                    found[feature][3] += 1
                for before, word in set(zip(["", *words], words, strict=False)):
                    context = 1 << zlib.crc32(before.encode()) % 63
                    for feature in features(word):
                        found[feature][2] |= context
            if len(found) > 1 << 18:
                yield _counts(found)
                found = {}
        yield _counts(found)

    parts = rows.select("text", "toxic").mapInArrow(
        count, "word string, toxic long, clean long, contexts long, texts long"
    )
    return parts.groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
        F.bit_count(F.bit_or("contexts")).alias("contexts"), F.sum("texts").alias("texts"),
    )


def _counts(found: dict[str, list[int]]) -> pa.RecordBatch:
    columns = [[counts[n] for counts in found.values()] for n in range(4)]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.string()), *(pa.array(c, pa.int64()) for c in columns)],
        ["word", "toxic", "clean", "contexts", "texts"],
    )


def log_odds(counts: DataFrame) -> DataFrame:
    """word, contexts, texts, score, z and share of clean words, under a prior of corpus shares.

    The score is the log-odds less one standard deviation, so what little is
    known of a word counts little.
    """
    totals = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    all_toxic, all_clean = (F.lit(float(n or 0)) for n in totals)
    prior = PRIOR * (F.col("toxic") + F.col("clean"))
    strength = PRIOR * (all_toxic + all_clean)
    t, c = F.col("toxic") + prior, F.col("clean") + prior
    odds_t = t / (all_toxic + strength - t)
    odds_c = c / (all_clean + strength - c)
    score = F.log(odds_t) - F.log(odds_c)
    spread = F.sqrt(1 / t + 1 / c)
    bound = F.signum(score) * F.greatest(F.abs(score) - spread, F.lit(0.0))
    return counts.select(
        "word", "contexts", "texts", bound.alias("score"), (score / spread).alias("z"),
        (c / (all_clean + strength)).alias("share"),
    )


def train(rows: DataFrame) -> Model:
    """A model of rows with text, toxic and calibrates; see ``labelled``.

    A quarter of the texts gives no counts and fits the extreme-value law and the
    logistic curve. Without both classes every text gets a low score.
    """
    rows = rows.persist()
    try:
        counts = written(word_counts(rows.where("NOT calibrates")), "word-counts")
        found = log_odds(counts).where(
            f"abs(z) >= {LEAST_Z} AND abs(score) >= {LEAST_SCORE} AND"
            f" (z < 0 OR contexts >= {LEAST_CONTEXTS} AND texts >= {LEAST_TEXTS})"
        ).toPandas()
        known = {w: (float(s), float(z)) for w, s, z in zip(found["word"], found["score"], found["z"], strict=True)}
        if not any(score > DRIFT for score, _ in known.values()):
            return Model({}, slope=0.0)
        rate = _rate(found["score"].to_numpy(float), found["share"].to_numpy(float))
        seen = _calibration(rows.where("calibrates"), known)
    finally:
        rows.unpersist()
    clean = [(s, n) for s, n, toxic in seen if not toxic and n]
    tails = [n * math.exp(-rate * max((x[0] for x in s), default=0.0)) for s, n in clean]
    model = Model(known, rate, len(tails) / sum(tails) if tails else 1.0)
    return Model(known, rate, model.scale, *_logistic(
        np.array([math.log1p(surprise(s, n, model)) for s, n, _ in seen]),
        np.array([float(toxic) for *_, toxic in seen]),
    ))


def _rate(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(rate * score)) = 1 over clean words."""
    each = np.append(scores - DRIFT, -DRIFT)
    share = np.append(shares, max(0.0, 1 - shares.sum()))
    low, high = 1e-3, 10.0
    for _ in range(60):
        middle = (low + high) / 2
        if np.sum(share * np.exp(np.minimum(middle * each, 500))) < 1:
            low = middle
        else:
            high = middle
    return low


def _calibration(rows: DataFrame, known: dict[str, tuple[float, float]]) -> list[tuple[list, int, int]]:
    """Segments, words and label of the calibrating texts, whose number is bounded."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(known)
        for batch in batches:
            words = [tokens(text) for text in texts(batch)]
            each = [[s for s, *_ in segments(w, scores)] for w in words]
            yield pa.RecordBatch.from_arrays(
                [pa.array(each, pa.list_(pa.float64())), pa.array(list(map(len, words)), pa.int64()),
                 batch.column("toxic")],
                ["scores", "n", "toxic"],
            )

    found = rows.select("text", "toxic").mapInArrow(work, "scores array<double>, n long, toxic int").collect()
    return [([(s, 0, 0) for s in r.scores], r.n, r.toxic) for r in found]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method with a little ridge."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (y - p) - 1e-3 * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(w[0], 0.0)), float(w[1])


def passages(text: str, found: list[tuple[float, int, int]], n: int, model: Model) -> list[dict]:
    """The significant segments as code point spans with their score and expected number."""
    high = [(s, a, b, e) for s, a, b in found if (e := expected(s, n, model)) <= MOST_EXPECTED]
    if not high:
        return []
    places = [m.span() for m in TOKEN.finditer(text)]
    return [
        {"start": places[a][0], "end": places[b - 1][1], "score": s, "expected": e} for s, a, b, e in high
    ]


PASSAGES = "array<struct<start:long,end:long,score:double,expected:double>>"


def score(docs: DataFrame, model: Model, text_col: str = "text", prefix: str = "") -> DataFrame:
    """The documents with score, predicted and passages, named with the prefix.

    Empty and null texts have no segments and the lowest score. Repeated rows and
    all other columns stay as they are; a column of a new name is an error.
    """
    new = [prefix + c for c in ("score", "predicted", "passages")]
    if clash := set(new) & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are there already; choose a prefix")
    get = sent(docs.sparkSession, model)
    kept = docs.columns
    spans = pa.list_(pa.struct([
        ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())
    ]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = get()
        scores = Scores(model.known)
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            chances, shown = [], []
            for text in texts(batch, text_col):
                words = tokens(text)
                found = segments(words, scores)
                chances.append(chance(found, len(words), model))
                shown.append(passages(text, found, len(words), model))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(chances, pa.float64()),
                 pa.array([int(c >= THRESHOLD) for c in chances], pa.int32()), pa.array(shown, spans)],
                [*kept, *new],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(work, f"{fields}, `{new[0]}` double, `{new[1]}` int, `{new[2]}` {PASSAGES}")
