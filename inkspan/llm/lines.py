"""Line dedup by a segment-partition edit join.

Lines that differ by a few characters, of short ones fewer (``edits``), are one class;
of a class the first line of all documents stays. If a line is cut into one segment
more than it may have edits, one of them is unchanged in every line that close. So
each distinct line is indexed by its segments, with its length, and asks for the
substrings of its own that a shorter or equally long line could have there. Lines that meet, and whose
signatures allow it, are compared by a banded bit-parallel edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspan.llm.common import WORD, text_of, written
from inkspan.llm.graph import components

#: Most edits of a link, and the lengths from which the shorter line may have one and two.
EDITS, EDITS_FROM = 2, (12, 24)
#: A line of so many words is long. Shorter ones, as headings, dates and greetings, are
#: no repeats by themselves; next to other repeated lines they are.
LEAST_WORDS = 8
#: Indexed lines under one substring that one task compares; more are split over tasks.
HOT = 4096
_BITMAP = 1 << 23
#: Finds LEAST_WORDS words; possessive, so that no blank is tried twice.
_LONG = rf"(?:{WORD}+[\x20\x09-\x0D]++){{{LEAST_WORDS - 1}}}[^\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"


def split_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", short: bool = False
) -> DataFrame:
    """doc_id, mark (a hash of the text), line_no, line and its number, for the long lines.

    With ``short``, for all that hold a word. A line counts without the blanks around it.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("mark"), text_of(text_col).alias("text"))
    each = rows.select("doc_id", "mark", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    each = each.withColumn("line", F.btrim("line", F.lit(BLANKS)))
    each = each.withColumn("is_long", F.col("line").rlike(_LONG))
    return each.where(F.col("line").rlike(WORD) if short else F.col("is_long")).withColumn("node", F.xxhash64("line"))


def edits(length: int) -> int:
    """How many edits two lines may have whose shorter one has this length."""
    return sum(length >= least for least in EDITS_FROM)


def segments(length: int) -> list[tuple[int, int]]:
    """Start and length of the segments of a line of this length; the last ones are longer."""
    n = edits(length) + 1
    size, longer = divmod(length, n)
    sizes = [size + (i >= n - longer) for i in range(n)]
    return [(sum(sizes[:i]), sizes[i]) for i in range(n)]


def probes(length: int) -> list[tuple[int, int, int, int]]:
    """(length, segment, start, size) of the substrings that a line of this length asks for.

    Only starts that leave enough edits for the parts before and after count.
    """
    found = []
    for shorter in range(max(EDITS_FROM[0], length - EDITS), length + 1):
        more, most = length - shorter, edits(shorter)
        if more > most:
            continue
        for i, (start, size) in enumerate(segments(shorter)):
            low = max(start - i, start + more - (most - i), 0)
            high = min(start + i, start + more + (most - i), length - size)
            found += [(shorter, i, at, size) for at in range(low, high + 1)]
    return found


def signatures(lines: list[bytes]) -> np.ndarray:
    """64 parities of the pairs of neighbouring characters of lines in UTF-32.

    One edit changes at most four of them.
    """
    points = np.frombuffer(b"".join(lines), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(lines)), np.fromiter(map(len, lines), np.int64, len(lines)) // 4)
    pairs, same = points[:-1] << np.uint64(21) | points[1:], owner[:-1] == owner[1:]
    bit = (pairs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(58)).astype(np.int64)
    odd = np.bincount((owner[:-1] * 64 + bit)[same], minlength=64 * len(lines)).reshape(-1, 64) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64).ravel()


def keyed(lines: DataFrame) -> DataFrame:
    """key, asks, node, signature: each line under its segments, and what it asks for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        seen: set[int] = set()  # copies of a line in one task are keyed once
        by_length: dict[int, tuple[list, list]] = {}
        for batch in batches:
            nodes, many = [], []
            for node, line in zip(batch.column("node").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    many.append(line.encode("utf-32-le"))
            if len(seen) > 1 << 18:
                seen.clear()
            keys, asks, counts = [], [], []
            for raw in many:
                length = len(raw) // 4
                if length not in by_length:
                    if len(by_length) > 1 << 14:
                        by_length.clear()
                    # Too short for edits: only equal lines are one class.
                    by_length[length] = (segments(length), probes(length)) if edits(length) else ([], [])
                cuts, wanted = by_length[length]
                keys += [digest(raw[4 * a : 4 * (a + n)], length << 2 | i) for i, (a, n) in enumerate(cuts)]
                keys += [digest(raw[4 * a : 4 * (a + n)], size << 2 | i) for size, i, a, n in wanted]
                asks += [False] * len(cuts) + [True] * len(wanted)
                counts.append(len(cuts) + len(wanted))
            marks = signatures(many)
            yield _rows(
                np.array(keys, np.uint64).view(np.int64), np.array(asks, bool),
                np.repeat(np.array(nodes, np.int64), counts), np.repeat(marks, counts),
            )

    return lines.select("node", "line").mapInArrow(work, "key long, asks boolean, node long, signature long")


def _rows(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "asks", "node", "signature"])


class _Group:
    """The indexed lines under one key, and which of the asking ones may be close to them."""

    def __init__(self, key: tuple, limit: int | None):
        self.key, self.limit, self.over = key, limit, False
        self.nodes, self.marks = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, nodes: np.ndarray, marks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take indexed lines; beyond the limit all are given back to be split."""
        if not self.over:
            self.nodes, first = np.unique(np.concatenate([self.nodes, nodes]), return_index=True)
            self.marks = np.concatenate([self.marks, marks])[first]
            if self.limit is None or len(self.nodes) <= self.limit:
                return
            nodes, marks, self.over = self.nodes, self.marks, True
        yield nodes, marks

    def ask(self, nodes: np.ndarray, marks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(nodes), 256):
            differ = np.bitwise_count((marks[at : at + 256, None] ^ self.marks[None]).view(np.uint64))
            q, x = np.nonzero(differ <= 4 * EDITS)
            a, b = nodes[at : at + 256][q], self.nodes[x]
            yield a[a != b], b[a != b]


def _meet(limit: int | None, *by: str):
    """Rows by key, indexed before asking, to pairs; groups beyond the limit as rows again."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in by]
            asks = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            nodes, marks = batch.column("node").to_numpy(), batch.column("signature").to_numpy()
            new = np.zeros(len(nodes), bool)
            for key in keys:
                new[1:] |= key[1:] != key[:-1]
            cuts = np.array([0, *np.flatnonzero(new), len(nodes)])
            # A key that one batch holds whole and only asks for, or has one line for, gives nothing.
            sizes, index = np.diff(cuts), np.add.reduceat((~asks).astype(np.int64), cuts[:-1])
            # The same goes for a key under which a line meets only itself or its copies.
            alone = np.minimum.reduceat(nodes, cuts[:-1]) == np.maximum.reduceat(nodes, cuts[:-1])
            idle = (index == 0) | (sizes == index) | alone
            idle[[0, -1]] = False
            out = {"pair": [], False: [], True: []}
            for n in np.flatnonzero(~idle):
                a, z = cuts[n], cuts[n + 1]
                key = tuple(k[a] for k in keys)
                if group is None or group.key != key:
                    group = _Group(key, limit)
                some = slice(a, a + index[n])
                for rows in group.add(nodes[some], marks[some]) if index[n] else ():
                    out[False].append((np.full(len(rows[0]), key[0]), *rows))
                some = slice(a + index[n], z)
                if group.over:
                    out[True].append((np.full(z - some.start, key[0]), nodes[some], marks[some]))
                elif len(group.nodes):
                    out["pair"] += group.ask(nodes[some], marks[some])
            yield from _out(out)

    return work


MET = "key long, asks boolean, node long, signature long"


def _out(out: dict) -> Iterator[pa.RecordBatch]:
    """Pairs have no key; their second line stands in place of the signature."""
    names = ["key", "asks", "node", "signature"]
    for kind, parts in out.items():
        if not parts:
            continue
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        if kind == "pair":
            both = np.unique(np.stack(columns, axis=1), axis=0)
            columns = [both[:, 0], both[:, 1]]
        n = len(columns[0])
        key = pa.nulls(n, pa.int64()) if kind == "pair" else pa.array(columns[0])
        yield pa.RecordBatch.from_arrays(
            [key, pa.array(np.full(n, kind is True)), *(pa.array(c) for c in columns[-2:])], names
        )


def met_lines(lines: DataFrame) -> DataFrame:
    """a < b: the pairs of lines that share a substring and whose signatures are close.

    A substring of many different lines is split: its indexed lines go to as many
    tasks as they need, and each asking line to all of these.
    """
    def by_key(rows: DataFrame, *by: str) -> DataFrame:
        return rows.repartition(*by).sortWithinPartitions(*by, "asks")

    first = written(by_key(keyed(lines), "key").mapInArrow(_meet(HOT, "key"), MET), "met-lines")
    pairs = first.where("key IS NULL")
    hot = first.where("key IS NOT NULL")
    counts = hot.where("NOT asks").groupBy("key").agg(F.ceil(F.count("*") / HOT).cast("int").alias("pieces"))
    split = hot.join(counts, "key").withColumn("piece", F.explode(
        F.when(F.col("asks"), F.sequence(F.lit(0), F.col("pieces") - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
        )
    ))
    rest = by_key(split, "key", "piece").mapInArrow(_meet(None, "key", "piece"), MET)
    both = pairs.unionByName(rest).select(
        F.least("node", "signature").alias("a"), F.greatest("node", "signature").alias("b")
    )
    return both.distinct()


def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most ``most``, by a band of bits along the diagonal.

    Bit i of the band stands for row j - most + i in column j. vp and vn hold where
    a value rises or falls from one row to the next, and move down with the band.
    """
    if abs(len(a) - len(b)) > most:
        return False
    low, high = 0, min(len(a), len(b))
    while low < high and a[low] == b[low]:
        low += 1
    end = 0
    while end < high - low and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[low : len(a) - end], b[low : len(b) - end]
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a) <= most
    rows, width = len(a), 2 * most + 1
    every, top = (1 << width) - 1, 1 << (width - 1)
    places: dict[str, int] = {}
    for row, character in enumerate(a):
        places[character] = places.get(character, 0) | 1 << (row + most)
    vp, vn = every & ~((1 << most) - 1), 0
    value = most  # of row j + most in column j, then of the last row
    for j, character in enumerate(b):
        equal = places.get(character, 0) >> j & every
        d0 = (((equal & vp) + vp) ^ vp) | equal | vn
        hp, hn = vn | ~(d0 | vp), d0 & vp
        last = rows - 1 - j + most  # the bit of the last row
        if last >= width - 1:
            value += not d0 & top
        else:
            value += (hp >> last & 1) - (hn >> last & 1)
        vp, vn = (hn | ~(d0 >> 1 | hp)) & every, d0 >> 1 & hp & every
    return value <= most if rows - len(b) <= most else False


def links(lines: DataFrame) -> DataFrame:
    """a, b: the pairs of different lines within ``edits`` of each other.

    The texts of the lines in some pair are fetched; a bitmap of fixed size goes to
    every task first, so that other lines are not shuffled.
    """
    pairs = written(met_lines(lines), "line-pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    place = F.pmod(F.xxhash64("node"), F.lit(_BITMAP))
    bits = nodes.select(place.alias("place")).groupBy((F.col("place") / 64).cast("long").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits")
    )
    marked = lines.select("node", "line").withColumn("place", place).withColumn(
        "word", (F.col("place") / 64).cast("long")
    )
    # At most _BITMAP / 64 rows, 2 MB.
    maybe = marked.join(F.broadcast(bits), "word").where(
        F.expr("shiftright(bits, cast(place % 64 as int)) & 1 = 1")
    )
    texts = written(maybe.groupBy("node").agg(F.first("line").alias("line")), "line-texts")
    met = pairs.join(texts.toDF("a", "line_a"), "a").join(texts.toDF("b", "line_b"), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("line_a").to_pylist(), batch.column("line_b").to_pylist(), strict=True)
            near = pa.array([within(a, b, edits(min(len(a), len(b)))) for a, b in both], pa.bool_())
            yield batch.select(["a", "b"]).filter(near)

    return met.select("a", "b", "line_a", "line_b").mapInArrow(verify, "a long, b long")


def _at() -> Column:
    """Where a line stands: documents by id, null ids last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark", "line_no")


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", short: bool = False
) -> DataFrame:
    """One row per long line: doc_id, mark, line_no, class_id, n_links and whether it is the first.

    With ``short``, one per line that holds a word; is_long tells them apart, and is_new
    whether no equal line stands before. class_id is the smallest number of a line's
    text in its class, n_links how many different texts are within ``edits`` of it, of
    a line too short for any none. Null texts have no lines; rows that are
    equal in id and text are one document here.
    """
    lines = split_lines(docs, id_col, text_col, short)
    seen = written(lines.select("node", "is_long", _at().alias("at")), "line-places")
    near = written(links(lines), "line-links")
    degree = near.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(
        F.count("*").alias("n_links")
    )
    roots = components(near)
    by_node = seen.groupBy("node").agg(F.min("at").alias("first"))
    named = by_node.join(roots, "node", "left").join(degree, "node", "left").select(
        "node", "first", F.coalesce("root", "node").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    named = written(named, "line-classes")
    least = named.groupBy("class_id").agg(F.min("first").alias("first"))
    of_node = named.select("node", "class_id", "n_links", F.col("first").alias("own")).join(least, "class_id")
    return seen.join(of_node, "node").select(
        F.col("at.doc_id").alias("doc_id"), F.col("at.mark").alias("mark"),
        F.col("at.line_no").alias("line_no"), "class_id", "n_links", (F.col("at") == F.col("first")).alias("is_first"),
        "is_long", (F.col("at") == F.col("own")).alias("is_new"),
    )


def runs(text: str, repeated: set[int]) -> list[int]:
    """The repeated lines that stand in a run of them with ``LEAST_WORDS`` words in all.

    Lines without words are in no run and end none.
    """
    found, run, words = [], [], 0
    for number, line in enumerate([*text.split("\n"), None]):
        if number in repeated and line is not None:
            run.append(number)
            words += len(line.encode().split())
        elif line is None or line.strip(BLANKS):
            found += run if words >= LEAST_WORDS else []
            run, words = [], 0
    return found


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", short: bool = False
) -> DataFrame:
    """The documents without long lines that stand, but for some edits, in an earlier place.

    With ``short``, also without the shorter lines that are equal to an earlier one and
    stand in a run of repeated lines with ``LEAST_WORDS`` words in all; so a copy goes
    whole, and a greeting between lines of a document's own stays. A document that loses
    all its words goes; one that loses no line stays as it is, empty and null texts too.
    ``n_chars``, if there, is counted anew.
    """
    found = classes(docs, id_col, text_col, short).where("CASE WHEN is_long THEN NOT is_first ELSE NOT is_new END")
    gone = found.groupBy("doc_id", "mark").agg(F.collect_set("line_no").alias("_gone")).toDF("_g_id", "_g_mark", "_gone")
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    rows = rows.select("_row", F.col("_row")[id_col].alias("_id"), F.xxhash64(F.col("_row")[text_col]).alias("_mark"))
    on = rows["_id"].eqNullSafe(gone["_g_id"]) & (rows["_mark"] == gone["_g_mark"])
    met = rows.join(gone.hint("merge"), on, "left")

    @F.pandas_udf("array<int>")
    def in_runs(texts, repeated):
        both = zip(texts, repeated, strict=True)
        return pd.Series([None if n is None else runs(t, set(map(int, n))) for t, n in both], dtype=object)

    if short:
        some = F.when(F.col("_gone").isNotNull(), F.col("_row")[text_col])
        # Else the last filter would call it once more, in a second Python process of each task.
        met = met.withColumn("_gone", in_runs.asNondeterministic()(some, "_gone"))
        met = met.withColumn("_gone", F.when(F.size("_gone") > 0, F.col("_gone")))
    met = met.withColumn("_lines", F.split(F.col("_row")[text_col], "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    text = F.when(F.col("_gone").isNull(), F.col("_row")[text_col]).otherwise(
        F.array_join(F.transform(kept, lambda i: F.element_at("_lines", i + 1)), "\n")
    )
    met = met.withColumn("_text", text).where(F.col("_gone").isNull() | F.col("_text").rlike(WORD))
    return met.select(*(
        F.col("_text").alias(c) if c == text_col else
        F.when(F.col("_gone").isNull(), F.col("_row")[c]).otherwise(F.length("_text")).cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" else F.col("_row")[c].alias(c)
        for c in docs.columns
    ))
