"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a hash of the letter.
The vector of an n-gram binds its letters: each is shifted by its place and all
are multiplied. A text's vector bundles, that is sums, those of its n-grams; the
prototype of a language bundles all its texts. A text is in the language whose
prototype makes the smallest angle with its vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.llm.common import sent, texts

DIMENSIONS = 1024
N = 3
SEED = 2
UNKNOWN = "und"
#: Prototypes go to every task, so their number is bounded.
MOST_LANGUAGES = 4096
#: Code points and texts that are turned into n-grams at a time, but for a single longer text.
AT_ONCE = 1 << 18
TEXTS_AT_ONCE = 64
#: n-grams that are bound at a time.
GRAMS_AT_ONCE = 1 << 14


#: What has been made in this process; plain dicts, which travel with the functions.
_MADE: dict[str, np.ndarray] = {}
_VECTORS: dict[int, np.ndarray] = {}


def _letters() -> np.ndarray:
    """For each code point its letter in lower case, or 0: it ends a word."""
    if "letters" in _MADE:
        return _MADE["letters"]
    found = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            small = letter.lower()
            found[point] = ord(small) if len(small) == 1 else point
    _MADE["letters"] = found
    return found


def letter_vector(point: int) -> np.ndarray:
    if point not in _VECTORS:
        if len(_VECTORS) >= 1 << 14:
            _VECTORS.clear()
        draw = np.random.Generator(np.random.Philox(key=[SEED, point]))
        _VECTORS[point] = draw.integers(0, 2, DIMENSIONS).astype(np.int8) * 2 - 1
    return _VECTORS[point]


def bind(grams: np.ndarray) -> np.ndarray:
    """The vectors of n-grams, given as rows of code points."""
    points, place = np.unique(grams, return_inverse=True)
    vectors = np.stack([letter_vector(int(p)) for p in points])
    place = place.reshape(grams.shape)
    bound = vectors[place[:, 0]]
    for n in range(1, grams.shape[1]):
        bound = bound * np.roll(vectors, n, axis=1)[place[:, n]]
    return bound


def bundle(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each row of counts the sum of the n-grams' vectors; whole numbers."""
    total = np.zeros((counts.shape[0], DIMENSIONS), np.float64)
    for at in range(0, len(grams), GRAMS_AT_ONCE):
        some = slice(at, at + GRAMS_AT_ONCE)
        total += counts[:, some].astype(np.float32) @ bind(grams[some]).astype(np.float32)
    return total


def count_grams(many: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of some texts, and for each text (row) how often it holds each.

    A word counts with a space (0) on either side; other characters are spaces.
    """
    letters = _letters()
    spaced = "\0" + "\0\0".join(many) + "\0"
    points = letters[np.frombuffer(spaced.encode("utf-32-le"), np.uint32)]
    lengths = np.fromiter(map(len, many), np.int64, len(many))
    owner = np.repeat(np.arange(len(many)), lengths + 2)
    size = points.size - N + 1
    present, small = _kinds(points, 0x110000)
    windows = [small[n : n + size] for n in range(N)]
    middle = np.ones(size, bool)
    for n in range(1, N - 1):
        middle &= points[n : n + size] != 0  # a space may only begin or end an n-gram
    code = np.zeros(size, np.int64)
    for window in windows:
        code = code * present.size + window
    code, owner = code[middle], owner[:size][middle]
    kinds, kind = _kinds(code, present.size ** N)
    table = np.bincount(owner * kinds.size + kind, minlength=len(many) * kinds.size)
    grams = np.stack([kinds // present.size ** (N - 1 - n) % present.size for n in range(N)], axis=1)
    return present[grams], table.reshape(len(many), kinds.size)


def _kinds(code: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """np.unique with inverse, by a table where the codes are small enough."""
    if most > 1 << 22:
        return np.unique(code, return_inverse=True)
    seen = np.zeros(most, bool)
    seen[code] = True
    kinds = np.flatnonzero(seen)
    number = np.zeros(most, np.int32)
    number[kinds] = np.arange(kinds.size)
    return kinds, number[code]


def groups(many: list[str]) -> Iterator[slice]:
    """Runs of texts of at most ``AT_ONCE`` code points, or of one longer text."""
    start = size = 0
    for at, text in enumerate(many):
        if at - start == TEXTS_AT_ONCE or at > start and size + len(text) > AT_ONCE:
            yield slice(start, at)
            start, size = at, 0
        size += len(text)
    if many:
        yield slice(start, len(many))


@dataclass(frozen=True)
class Prototypes:
    languages: tuple[str, ...]
    vectors: np.ndarray  # one row per language, of length 1


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Prototypes:
    """The prototypes of all rows with a language.

    Tasks send one vector per language; the sums are whole numbers, so they are
    equal in any order. Only the sums of at most ``MOST_LANGUAGES`` come back.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL")

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, many = batch.column("lang").to_pylist(), texts(batch)
            for part in groups(many):
                grams, counts = count_grams(many[part])
                if not counts.size:
                    continue
                own = np.array(langs[part])
                names = sorted(set(langs[part]))
                added = bundle(grams, np.stack([counts[own == lang].sum(0) for lang in names]))
                for lang, vector in zip(names, added, strict=True):
                    sums[lang] = sums.get(lang, 0) + np.rint(vector).astype(np.int64)
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(vector)],
                ["lang", "place", "value"],
            )

    parts = rows.mapInArrow(sum_up, "lang string, place int, value long")
    sums = parts.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    found = sums.limit(MOST_LANGUAGES * DIMENSIONS + 1).toPandas()
    if len(found) > MOST_LANGUAGES * DIMENSIONS:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    wide = found.pivot(index="lang", columns="place", values="value").sort_index()
    vectors = wide.to_numpy(np.float64).reshape(len(wide), DIMENSIONS if len(wide) else 0)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Prototypes(tuple(wide.index), (vectors / np.where(length, length, 1)).astype(np.float32))


def predict(many: list[str], prototypes: Prototypes) -> tuple[list[str], np.ndarray]:
    """The language of each text and the cosine with its prototype, 0 at least."""
    languages, scores = [], []
    for part in groups(many):
        grams, counts = count_grams(many[part])
        if not counts.size or not prototypes.languages:
            languages += [UNKNOWN] * (part.stop - part.start)
            scores.append(np.zeros(part.stop - part.start))
            continue
        bundled = bundle(grams, counts)
        length = np.linalg.norm(bundled, axis=1)
        cosine = (bundled @ prototypes.vectors.T) / np.where(length, length, 1)[:, None]
        best = cosine.argmax(1)
        some = counts.any(1)
        languages += [prototypes.languages[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
        scores.append(np.where(some, np.clip(cosine.max(1), 0, 1), 0.0))
    return languages, np.concatenate(scores) if scores else np.zeros(0)


def identify(
    docs: DataFrame, prototypes: Prototypes, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, lang_pred and score, the cosine.

    Texts without a letter, empty and null ones are ``und`` with score 0; without
    any prototype all are. Equal cosines go to the first language by name.
    Repeated rows and null ids stay; no other column is read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    get = sent(rows.sparkSession, prototypes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = get()
        for batch in batches:
            languages, scores = predict(texts(batch), known)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, lang_pred string, score double")
