"""Spelling variants: words of a corpus that differ by one edit, grouped by frequency.

Words are compared in dense tiles: the code points of a block of words make a padded
matrix, two such matrices are compared column by column from both ends, and two words
are one edit apart when common prefix and common suffix together reach the length of
the longer one minus one.

Which blocks meet: an edit lies in the first or in the second half of the longer word,
so the other half stands unchanged at the beginning or at the end of both. A word goes
to the tiles of its own length and of the next, by its first and by its last half;
only words that share such a half are in one tile. A half that many words share is cut into blocks
of ``BLOCK`` words, and each pair of blocks is a tile of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm.common import written
from inkspan.session import discard, shared_folder

RUN = r"[A-Za-zÀ-ÿ]+"
#: Code points of the shortest word, and the occurrences of the rarest.
LEAST_LENGTH, LEAST_TIMES = 5, 3
#: One run in so many loses a code point.
DROPPED = 97
#: A form occurs so many times as often as its variant, at least.
RATIO = 2
#: Words of a block, and cells of two matrices compared at once.
BLOCK, CELLS = 1 << 11, 1 << 21

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n, its occurrences in all texts.

    Runs are lower-cased in A-Z only. Where the checksum of id and run divides by
    ``DROPPED``, the run loses the code point that the checksum names. A null id counts
    as an empty one. Counts are added up before they are shuffled.
    """
    run = F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(RUN), F.lit(0)))
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run.alias("raw"))
    runs = runs.where(F.length("raw") >= LEAST_LENGTH)
    runs = runs.select("id", F.translate("raw", _UPPER, _LOWER).alias("run"))
    runs = runs.withColumn("sum", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("sum") % F.length("run")).cast("int")
    less = F.concat(F.expr("substring(run, 1, int(sum % length(run)))"), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(F.col("sum") % DROPPED == 0, less).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_TIMES)


def near_words(words: DataFrame) -> DataFrame:
    """word, other: both directions of every pair of distinct words one edit apart.

    ``words`` has a column ``word`` of distinct words of two code points or more.
    """
    length = F.length("word").cast("int")
    role = lambda longer: F.struct(longer.alias("longer"))
    placed = words.select("word", length.alias("length"), F.explode(F.array(role(length), role(length + 1))).alias("at"))
    placed = placed.select("word", "length", F.col("at.longer").alias("longer"))
    half = F.expr("int(longer / 2)")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.expr("substring(word, 1, int(longer / 2))").alias("part")),
        F.struct(F.lit(1).alias("side"), F.expr("right(word, longer - int(longer / 2))").alias("part")),
    )
    keyed = placed.select("word", "length", "longer", half.alias("half"), F.explode(sides).alias("by"))
    keyed = keyed.select("word", "length", "longer", F.col("by.side").alias("side"), F.xxhash64("longer", "by.side", "by.part").alias("key"))
    # Only a half that several words share makes a tile; large ones are cut into blocks.
    sizes = keyed.groupBy("key").agg(
        F.count("*").alias("many"), F.count(F.when(F.col("length") == F.col("longer"), 1)).alias("full")
    ).where("many > 1 AND full > 0").select("key", F.ceil(F.col("many") / BLOCK).cast("int").alias("blocks"))
    keyed = keyed.join(sizes.hint("merge"), "key")
    keyed = keyed.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    tiles = keyed.select("*", F.explode(others).alias("other")).select(
        "key", "longer", "side", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
        "block", "word",
    )
    order = ["key", "longer", "side", "a", "b", "block"]
    # As many tasks as asked for: the work of a tile grows with the square of its bytes.
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = tiles.repartition(tasks, "key", "a", "b").sortWithinPartitions(*order)
    found = tiles.mapInArrow(_tile_pairs, "word string, other string")
    return found.unionByName(found.select(F.col("other").alias("word"), F.col("word").alias("other")))


def _tile_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of each tile, whose rows come one after the other; a tile may go on in the next batch."""
    left = None
    for batch in batches:
        rows = pa.Table.from_batches([batch] if left is None else [*left.to_batches(), batch]).combine_chunks()
        heads = np.stack([rows[name].to_numpy() for name in ("key", "longer", "side", "a", "b")], axis=1)
        starts = np.flatnonzero(np.concatenate([[True], (heads[1:] != heads[:-1]).any(axis=1)]))
        yield from _pairs(rows.slice(0, starts[-1]), starts)
        left = rows.slice(starts[-1])
    if left is not None:
        yield from _pairs(left, np.array([0, left.num_rows]))


def _pairs(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not rows.num_rows:
        return
    words, block = rows["word"].to_pylist(), rows["block"].to_numpy()
    longer, side = rows["longer"].to_numpy(), rows["side"].to_numpy()
    a, b = rows["a"].to_numpy(), rows["b"].to_numpy()
    found = []
    for start, stop in zip(starts[:-1], starts[1:], strict=True):
        if stop - start < 2:
            continue
        if a[start] == b[start]:
            first = second = words[start:stop]
        else:
            cut = start + np.searchsorted(block[start:stop], b[start])
            first, second = words[start:cut], words[cut:stop]
        found += _one_edit(first, second, int(longer[start]), int(side[start]))
    if found:
        ours, theirs = zip(*found, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(ours, pa.string()), pa.array(theirs, pa.string())], ["word", "other"])


def code_points(words: list[str], width: int) -> np.ndarray:
    """A row of code points for each word, padded with zeros."""
    raw = "".join(word.ljust(width, "\0") for word in words).encode("utf-32-le")
    return np.frombuffer(raw, np.uint32).reshape(len(words), width)


def _one_edit(first: list[str], second: list[str], longer: int, side: int) -> list[tuple[str, str]]:
    """Pairs of two blocks whose longer word has ``longer`` code points, one edit apart.

    A pair that shares its first half is found by side 0 and not again by side 1.
    """
    if first is second:
        long = [word for word in first if len(word) == longer]
        short = [word for word in first if len(word) < longer]
        return [
            *_compared(long, long, longer, side, once=True), *_compared(long, short, longer, side)
        ]
    found = []
    for ours, theirs in ((first, second), (second, first)):
        long = [word for word in ours if len(word) == longer]
        short = [word for word in theirs if len(word) < longer]
        found += _compared(long, short, longer, side)
    both = [[word for word in words if len(word) == longer] for words in (first, second)]
    return [*found, *_compared(*both, longer, side)]


def _compared(long: list[str], others: list[str], longer: int, side: int, once: bool = False) -> list[tuple[str, str]]:
    """The pairs of words of ``longer`` code points and of others, all as long or all one shorter."""
    if not long or not others:
        return []
    width = len(others[0])
    ours, theirs = code_points(long, longer), code_points(others, width)
    found, rows = [], max(1, CELLS // len(others))
    for top in range(0, len(long), rows):
        part = ours[top : top + rows]
        prefix = _common(part, theirs, width)
        suffix = _common(part[:, ::-1], theirs[:, ::-1], width)
        near = prefix + suffix >= longer - 1
        if width == longer:
            near &= prefix < longer  # not the same word
        if side:
            near &= prefix < longer // 2
        if once:
            near &= np.arange(top, top + len(part))[:, None] < np.arange(len(others))[None, :]
        found += [(long[top + i], others[j]) for i, j in np.argwhere(near)]
    return found


def _common(ours: np.ndarray, theirs: np.ndarray, width: int) -> np.ndarray:
    """How many leading columns each pair of rows has in common."""
    alive = np.ones((len(ours), len(theirs)), bool)
    length = np.zeros(alive.shape, np.int32)
    for column in range(width):
        alive &= ours[:, column, None] == theirs[None, :, column]
        if not alive.any():
            break
        length += alive
    return length


def forms(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word, from columns ``word`` and ``n``.

    A word's form is its near word of most occurrences, equal ones by code points, if
    that has ``RATIO`` times as many; the root is where the forms end.
    """
    words = written(words, "vocabulary")
    pairs = near_words(words.select("word"))
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = pairs.join(counts.hint("merge"), "other")
    best = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    met = words.join(best.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.col("best.other").alias("best"), (-F.col("best.less")).alias("best_n"),
    )
    kept = F.col("best_n") >= RATIO * F.col("n")
    with_form = written(met.select(
        "word", "n", "n_near", F.when(kept, F.col("best")).alias("form"), F.when(kept, F.col("best_n")).alias("form_n")
    ), "forms")
    ends = roots(with_form.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return with_form.join(ends.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(links: DataFrame) -> DataFrame:
    """Where the links word -> root end. Each round doubles how far a link reaches.

    A form has twice its variant's occurrences at least, so the ways are without
    rings and no longer than the logarithm of the largest count, and few rounds do.
    """
    spark = links.sparkSession
    now, path = _put(spark, links)
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(onward.hint("merge"), "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        after, new = _put(spark, step)
        if after.where("moved").isEmpty():
            return after.drop("moved")
        discard(spark, path)
        now, path = after.drop("moved"), new


def _put(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, str]:
    path = shared_folder(spark, "roots")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path), path


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The words of all texts with their forms and roots (``vocabulary``, ``forms``).

    Null and empty texts have no words, repeated rows count again; of the table only
    id and text are read. An empty table has no words.
    """
    return forms(vocabulary(docs, id_col, text_col))
