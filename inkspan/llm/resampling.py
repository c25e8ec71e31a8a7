"""Target-distribution importance resampling of documents.

Features are the runs of one to three words, hashed to buckets. The gain of a bucket
is the logarithm of how much likelier it is in the target texts than in the corpus; a
document weighs the sum of its gains, and the documents of the highest weight plus
Gumbel noise are drawn, which samples without replacement by weight.

A newline always separates words, so it cuts a text into lines without cutting a
feature's word. The features inside a line depend on the line alone: they are worked
out once per distinct line, and count as often as the line occurs. What reaches over
the end of a line is worked out per text from the last and first two words of the
lines that meet, and added.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from inkspan.llm.common import by_slice, texts, written

#: Buckets of features, and words of the longest feature.
BUCKETS, LONGEST = 10_000, 3
#: Documents of fewer words are not drawn; of the others this share in hundredths is.
LEAST_WORDS, SHARE = 20, 5
SEED = "42"
#: A line with more than one of so many occurrences of all lines is joined by broadcast.
HOT_SHARE = 1000

#: Lines that a task works on at a time.
LINES = 1 << 13

#: Bytes with A-Z lower-cased, and a blank for every ASCII sign but letters and digits.
_BLANKED = bytes(
    byte if byte > 127 or chr(byte).isalnum() else 32 for byte in bytes(range(256)).lower()
)


def words_of(text: bytes, _table: bytes = _BLANKED) -> list[bytes]:
    """The words of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_table).split()


def line_features(words: list[bytes]) -> list[int]:
    """The buckets of the features inside a line, repeats included.

    The checksum of a longer feature goes on from that of the shorter one before it.
    """
    spaced = [b" " + word for word in words]
    one = list(map(crc32, words))
    two = list(map(crc32, spaced[1:], one))
    three = map(crc32, spaced[2:], two)
    return [value % BUCKETS for value in (*one, *two, *three)]


def crossing_features(lines: list[list[bytes]]) -> list[int]:
    """The buckets of the features that reach over the end of a line.

    ``lines`` holds the words of each line, of none without any. At each end the last
    two words before it meet the first two after it, which may be of several short lines.
    """
    found = []
    for number in range(len(lines) - 1):
        last, after = lines[number][-2:], []
        for line in lines[number + 1 : number + 3]:
            after += line[: 2 - len(after)]
        found.append(b" ".join((last[-1], after[0])))
        if len(last) > 1:
            found.append(b" ".join((*last, after[0])))
        if len(after) > 1:
            found.append(b" ".join((last[-1], *after)))
    return [crc32(feature) % BUCKETS for feature in found]


def _read(batch: pa.RecordBatch) -> pa.RecordBatch:
    """n_words, the keys of the lines with words, and the crossing buckets of each text."""
    counts, keys, crossing = [], [], []
    for text in texts(batch):
        lines = [(line, words) for line in text.encode().split(b"\n") if (words := words_of(line))]
        counts.append(sum(len(words) for _, words in lines))
        keys.append([xxh3_128_digest(line) for line, _ in lines])
        crossing.append(crossing_features([words for _, words in lines]))
    columns = [
        batch.column("row"), batch.column("doc_id"), pa.array(counts, pa.int64()),
        pa.array(keys, pa.list_(pa.binary())), pa.array(crossing, pa.list_(pa.int16())),
    ]
    return pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_words", "keys", "crossing"])


def _read_lines(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The key of each distinct line, and the buckets inside it."""
    lines = [line.encode() for line in texts(batch, "line")]
    columns = [
        pa.array(map(xxh3_128_digest, lines), pa.binary()), batch.column("times"),
        pa.array([line_features(words_of(line)) for line in lines], pa.list_(pa.int16())),
    ]
    return pa.RecordBatch.from_arrays(columns, ["key", "times", "inside"])


class Features:
    """The features of a table of texts, as two written tables.

    ``documents``: row, doc_id, n_words, the keys of the lines that hold a word and the
    buckets that reach over lines. ``lines``: each distinct line's key, how often it
    occurs, and its buckets.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        id_type = rows.schema["doc_id"].dataType.simpleString()
        numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        self.documents = written(numbered.mapInArrow(
            by_slice(_read),
            f"row bigint, doc_id {id_type}, n_words bigint, keys array<binary>, crossing array<smallint>",
        ), "features-documents")
        each = rows.select(F.explode(F.split("text", "\n")).alias("line")).where("line != ''")
        distinct = each.groupBy("line").agg(F.count("*").alias("times"))
        per_line = distinct.mapInArrow(
            by_slice(_read_lines, LINES), "key binary, times bigint, inside array<smallint>"
        )
        self.lines = written(per_line.where(F.size("inside") > 0), "features-lines")

    def totals(self) -> np.ndarray:
        """How often each bucket occurs in all texts."""
        inside = _counted(self.lines.select(F.col("inside").alias("buckets"), "times"))
        crossing = _counted(self.documents.select(F.col("crossing").alias("buckets"), F.lit(1).cast("long").alias("times")))
        counts = inside.unionByName(crossing).groupBy("bucket").agg(F.sum("n").alias("n"))
        found = np.zeros(BUCKETS, np.int64)
        for row in counts.collect():  # one row per bucket at most
            found[row.bucket] = row.n
        return found

    def weighed(self, gains: np.ndarray) -> DataFrame:
        """row, doc_id, n_words, n_features and weight, the sum of the gains of its features.

        Lines meet their weight by key; the few that hold more than one in ``HOT_SHARE``
        of all occurrences, which are fewer than ``HOT_SHARE``, are sent to all tasks.
        """
        lines = _summed(self.lines, "inside", gains, "key binary, times bigint")
        lines = written(lines, "line-weights")
        all_times = lines.agg(F.sum("times")).first()[0] or 0
        hot = F.col("times") * HOT_SHARE > all_times
        held = self.documents.select("row", F.explode("keys").alias("key"))
        known = F.broadcast(lines.where(hot).select("key", F.col("n").alias("hot_n"), F.col("weight").alias("hot_weight")))
        met = written(held.join(known, "key", "left"), "line-places")
        rest = met.where("hot_n IS NULL").select("row", "key")
        rest = rest.join(lines.where(~hot).select("key", "n", "weight").hint("merge"), "key")
        parts = rest.select("row", "n", "weight").unionByName(
            met.where("hot_n IS NOT NULL").select("row", F.col("hot_n").alias("n"), F.col("hot_weight").alias("weight"))
        )
        own = _summed(self.documents, "crossing", gains, "row bigint, doc_id {}, n_words bigint".format(
            self.documents.schema["doc_id"].dataType.simpleString()
        ))
        inside = parts.groupBy("row").agg(F.sum("n").alias("line_n"), F.sum("weight").alias("line_weight"))
        nothing = F.lit(0).cast("long")
        return own.join(inside.hint("merge"), "row", "left").select(
            "row", "doc_id", "n_words",
            (F.col("n") + F.coalesce("line_n", nothing)).alias("n_features"),
            (F.col("weight") + F.coalesce("line_weight", nothing)).alias("weight"),
        )


def _parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The elements of a list column, and how many each row has."""
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), sizes


def _counted(rows: DataFrame) -> DataFrame:
    """bucket and n: each task's sum of the times of its rows' buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            buckets, sizes = _parts(batch.column(0))
            np.add.at(total, buckets, np.repeat(batch.column(1).to_numpy(), sizes))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    return rows.mapInArrow(count, "bucket int, n bigint")


def _summed(rows: DataFrame, buckets: str, gains: np.ndarray, kept: str) -> DataFrame:
    """The rows with how many buckets they hold and the sum of their gains."""
    names = [part.split(" ")[0] for part in kept.split(", ")]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = _parts(batch.column(len(names)))
            run = np.concatenate([[0], np.cumsum(gains[found])])
            stops = np.cumsum(sizes)
            weights = run[stops] - run[stops - sizes]
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int64()), pa.array(weights, pa.int64())], [*names, "n", "weight"]
            )

    return rows.select(*names, buckets).mapInArrow(add, f"{kept}, n bigint, weight bigint")


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket: 1000 times the logarithm of the ratio of shares, floored."""
    share = (target + 1) * (corpus.sum() + BUCKETS) / ((corpus + 1) * (target.sum() + BUCKETS))
    return np.floor(1000 * np.log(share)).astype(np.int64)


def noise(doc_id: Column) -> Column:
    """Gumbel noise of an id, times 1000 and floored; a null id counts as an empty one."""
    digits = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    number = F.conv(F.substring(digits, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((number + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is null if not drawn.

    The ``SHARE`` hundredths of the documents of ``LEAST_WORDS`` words that score
    highest are drawn, equal scores by the smaller id, null ids last; rows alike in both are drawn in
    any order. Null and empty texts have no feature and weigh 0. An empty target only
    makes frequent buckets lose. Of both tables only id and text are read.
    """
    corpus = Features(docs, id_col, text_col)
    wanted = Features(target.select(F.lit(0).cast("long").alias("id"), F.col(text_col).alias("text")), "id", "text")
    weighed = corpus.weighed(gains(corpus.totals(), wanted.totals()))
    scored = written(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"))), "scores")
    able = F.col("n_words") >= LEAST_WORDS
    drawn = scored.where(able).count() * SHARE // 100
    ranked = ordered(scored.where(able), [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")])
    rank = F.when(F.col("place") <= drawn, F.col("place"))
    result = ranked.withColumn("rank", rank).unionByName(
        scored.where(~able).withColumn("rank", F.lit(None).cast("long")), allowMissingColumns=True
    )
    return result.select("doc_id", "n_features", "weight", "score", "rank")


def ordered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The rows with their ``place`` in an order, from 1, without ever sorting all in one task.

    Rows are dealt out by ranges of the order and written; the sizes of the ranges,
    one number for each, say where a range begins.
    """
    dealt = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    sizes = sorted(map(tuple, dealt.groupBy("part").count().collect()))  # one row per partition
    starts = dict(zip((part for part, _ in sizes), np.cumsum([0] + [n for _, n in sizes]).tolist(), strict=False))
    begins = rows.sparkSession.createDataFrame(list(starts.items()), "part int, begin long")
    inside = Window.partitionBy("part").orderBy(*order)
    placed = dealt.withColumn("place", F.row_number().over(inside).cast("long"))
    return placed.join(F.broadcast(begins), "part").withColumn("place", F.col("place") + F.col("begin")).drop("part", "begin")
