"""Document fingerprints by consistent weighted sampling.

A text is a bag of words, weighted by how often they occur. Each of ``SAMPLES``
positions draws one weighted word: with gamma variables r, c and a uniform b that
belong to word and position only, t = floor(ln(weight) / r + b), and the word with
the least c / (exp(r (t - b)) exp(r)) is drawn together with its t. Two texts draw
the same at a position with a chance equal to their generalised Jaccard
similarity, the sum of the lesser over the sum of the greater weights.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from inkspan.llm.common import text_of, texts, written

SAMPLES = 128
#: Words of a text that are worked on at a time, and those of them that occur more than once.
BLOCK_WORDS, BLOCK_HEAVY = 1 << 12, 1 << 9
SEED = 3
EMPTY = "0" * (4 * SAMPLES)
#: Documents of one block of the order that ``with_edited`` works through, and most blocks.
BLOCK_ROWS, MOST_BLOCKS = 2048, 1 << 16


#: Three rows of numbers for the positions, one for each uniform variable.
_POSITIONS = np.random.default_rng(SEED).integers(0, 1 << 32, (3, SAMPLES), np.uint32)


def _drawn(words: np.ndarray, number: int, positions: np.ndarray = _POSITIONS) -> np.ndarray:
    """A uniform 32-bit number of each word hash (row) and position, from both halves of the hash."""
    low, high = words.astype(np.uint32), (words >> np.uint64(32)).astype(np.uint32)
    found = low[:, None] ^ positions[number][None, :]
    found *= np.uint32(0x7FEB352D)
    found ^= found >> np.uint32(15)
    found += high[:, None]
    found *= np.uint32(0x846CA68B)
    found ^= found >> np.uint32(14)
    found *= np.uint32(0x9E3779B1)
    found ^= found >> np.uint32(16)
    return found


def _exponential(numbers: np.ndarray) -> np.ndarray:
    """Exponential variables of single precision, falling with the numbers."""
    return -np.log((numbers.astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-32))


def _rising(numbers: np.ndarray) -> np.ndarray:
    """Exponential variables, rising with the numbers; small ones keep their precision."""
    v = (numbers.astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-32)
    few = v * (1 + v * (np.float32(1 / 2) + v * (np.float32(1 / 3) + v * np.float32(1 / 4))))
    return np.where(v < 0.01, few, -np.log(np.maximum(1 - v, np.float32(2.0**-33))))


def _variables(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and b of each word and position, from the number that orders it at weight 1.

    At weight 1 the key is a = c exp(-r (1 - b)). With gamma variables of shape 2, r
    times 1 - b and r times b are two independent exponential ones, and so are a and
    c - a. So a, c - a and r b are drawn, and r, b and c follow with their own law.
    """
    a = _rising(first)
    c = a + _exponential(_drawn(words, 1))
    log_c = np.log(c)
    rb = _exponential(_drawn(words, 2))
    r = log_c - np.log(a) + rb
    return r, log_c, rb / r


def fingerprint(text: str) -> np.ndarray:
    """One 16-bit mark of the drawn word and t for each position; all 0 without words."""
    weights = Counter(text.encode().lower().split())
    if not weights:
        return np.zeros(SAMPLES, np.uint16)
    words = np.fromiter(map(xxh64_intdigest, weights), np.uint64, len(weights))
    return _draw(words, np.fromiter(weights.values(), np.float32, len(weights)))


def _draw(words: np.ndarray, weights: np.ndarray) -> np.ndarray:
    best, drawn, t_drawn = np.full(SAMPLES, np.inf), np.zeros(SAMPLES, np.uint64), np.zeros(SAMPLES)
    light = weights == 1
    for each, size, least in ((words[light], BLOCK_WORDS, _least_light), (words[~light], BLOCK_HEAVY, _least_heavy)):
        of_each = weights[~light]
        for start in range(0, len(each), size):
            some = each[start : start + size]
            at, key, t = least(some, of_each[start : start + size])
            better = key < best
            best[better], t_drawn[better] = key[better], t[better]
            drawn[better] = some[at[better]]
    drawn *= np.uint64(0x9E3779B97F4A7C15)
    drawn += t_drawn.astype(np.int64).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    drawn ^= drawn >> np.uint64(32)
    marks = ((drawn * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.uint16)
    return np.maximum(marks, 1)


def _least_light(words: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each position the word of weight 1 of least key, the key's logarithm and t, which is 0."""
    numbers = _drawn(words, 0)
    least = numbers.argmin(0)
    return least, np.log(_rising(numbers[least, np.arange(SAMPLES)])), np.zeros(SAMPLES)


def _least_heavy(words: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for words of greater weights."""
    r, log_c, b = _variables(words, _drawn(words, 0))
    t = np.floor(np.log(weights)[:, None] / r + b)
    keys = log_c - r * (t - b + 1)
    least, at = keys.argmin(0), np.arange(SAMPLES)
    return least, keys[least, at], t[least, at]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of positions with equal draws; two texts without words are alike."""
    return float(np.mean(a == b))


def hexed(marks: np.ndarray) -> str:
    return marks.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars and its fingerprint in hex.

    Null texts are empty, and all texts without words share one fingerprint.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = texts(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(map(len, many)), pa.int64()),
                 pa.array([hexed(fingerprint(t)) for t in many])],
                ["doc_id", "n_chars", "fingerprint"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_chars long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many of the next text's first."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third] if third else text


FIELDS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)


def _order_key(ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Byte keys that order by id, descending, and hash, ascending."""
    both = np.empty((len(ids), 2), ">u8")
    both[:, 0] = ~(ids.view(np.uint64) ^ np.uint64(1 << 63))
    both[:, 1] = hashes.view(np.uint64) ^ np.uint64(1 << 63)
    return both.view("S16")[:, 0]


def blocks(keys: DataFrame, rows: int = BLOCK_ROWS, most: int = MOST_BLOCKS) -> list[tuple[int, int, int]]:
    """Where each block of the order begins: id, hash, and over how many parts it is spread.

    ``keys`` holds the id and the hash of each row. Blocks have about ``rows`` rows, more
    where there would be over ``most``, and begin at a key that is there. A key with
    more rows than that is a block of its own, spread over several parts. Only these
    beginnings, three numbers for each block, come to the driver.
    """
    counted = written(keys.groupBy("id", "hash").agg(F.count("*").alias("n")), "order-keys")
    size = max(rows, -(-(counted.agg(F.sum("n")).first()[0] or 0) // most))
    order = [F.desc("id"), F.asc("hash")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], size
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("id", "hash", "n"))
            for key, hash_, n in zip(*columns, strict=True):
                if held >= size or n > size:
                    found.append((key, hash_, -(-n // size)))
                    held = 0
                held += n
        names = ["id", "hash", "parts"]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in found], pa.int64()) for i in range(3)], names
        )

    ranges = counted.repartitionByRange(*order).sortWithinPartitions(*order)
    begins = ranges.mapInArrow(cut, "id long, hash long, parts long").collect()
    return sorted((tuple(r) for r in begins), key=lambda r: (-r[0], r[1]))


def with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text and the next one, in descending id.

    The next of the last is the first. Null ids come last, equal ids in the order
    of a hash of their texts; null texts are empty. Blocks of this order are shuffled
    once and worked through, a text at a time; the first document of a block is sent
    to the block before as well, as its last one's next. So the last document of a
    block meets its next wherever the blocks are worked on. Rows of equal id and text
    that fill a block are spread, since each but the last has its own text as next.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")
    ).withColumn("id", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("hash", F.xxhash64("text"))
    begins = blocks(rows.select("id", "hash"))
    if not begins:
        return spark.createDataFrame([], FIELDS)
    table = np.array(begins, np.int64)
    starts, parts = _order_key(table[:, 0].copy(), table[:, 1].copy()), table[:, 2]
    firsts = np.concatenate([[0], np.cumsum(parts)])
    total = int(firsts[-1])
    sent = spark.sparkContext.broadcast((starts, parts, firsts))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row with its place, and the first of a block once more for the place before."""
        starts, parts, firsts = sent.value
        turn, heads = TaskContext.get().partitionId(), set()
        for batch in batches:
            keys = _order_key(batch.column("id").to_numpy(), batch.column("hash").to_numpy())
            block = np.searchsorted(starts, keys, "right") - 1
            spread = parts[block] > 1
            step = np.cumsum(spread) + turn
            turn = int(step[-1]) if len(step) else turn
            place = firsts[block] + np.where(spread, step % parts[block], 0)
            new = [i for i in np.flatnonzero(starts[block] == keys) if block[i] not in heads and not heads.add(block[i])]
            before = (firsts[block[new]] - 1) % total
            every = batch.take(pa.array(np.concatenate([np.arange(len(keys)), np.array(new, np.int64)])))
            yield pa.RecordBatch.from_arrays(
                [*every.columns, pa.array(np.concatenate([place, before]).astype(np.int32)),
                 pa.array(np.arange(len(keys) + len(new)) >= len(keys))],
                [*every.schema.names, "place", "extra"],
            )

    dealt = rows.mapInArrow(deal, "doc_id long, text string, id long, hash long, place int, extra boolean")
    dealt = dealt.repartitionById(total, "place").sortWithinPartitions("extra", F.desc("id"), "hash")
    return dealt.select("doc_id", "text", "extra").mapInArrow(_pairs, FIELDS)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the one after it in its place; the one after the last is extra.

    A place without an extra row holds equal texts, of which the last is followed by
    another one elsewhere.
    """
    before = None
    for batch in batches:
        out = []
        ids, many, extras = (batch.column(0).to_pylist(), texts(batch), batch.column("extra").to_pylist())
        for doc_id, text, extra in zip(ids, many, extras, strict=True):
            if before and before[2]:
                break  # the same first document, sent by several tasks
            own = before[3] if before and before[1] == text else fingerprint(text)
            if before:
                out.append(_compare(before[0], before[1], before[3], text, own))
            before = (doc_id, text, extra, own)
        yield _as_batch(out)
    if before and not before[2]:
        yield _as_batch([_compare(before[0], before[1], before[3], before[1], before[3])])


def _as_batch(out: list[tuple]) -> pa.RecordBatch:
    columns = zip(*out, strict=True) if out else [()] * 7
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in FIELDS.split(", ")]
    )


def _compare(doc_id: int, text: str, own: np.ndarray, following: str, its: np.ndarray) -> tuple:
    changed = edited(text, following)
    marks = own if changed == text else fingerprint(changed)
    return (
        doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), hexed(own), hexed(marks),
        likeness(own, marks), likeness(own, its),
    )
