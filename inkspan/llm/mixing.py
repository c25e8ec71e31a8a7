"""Mixing sources to target weights, with DataFrame functions only.

The documents of a source, in a seeded order, are one stream of tokens, packed
into blocks of a fixed length. The output is a sequence of slots of one block
each, cut into shards. A seeded permutation of all slots deals them to the
sources, so the source counts of a shard are a multinomial draw given the totals
of the mix, and each source gets its target to within a block. The slots of a
source walk through a pseudorandom permutation of its blocks, a new one for each
round through the source; slots and documents meet by block index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspan.llm.common import WORD, text_of, written

WEIGHTS = (5.0, 2.0, 1.0)
MOST_ROUNDS = 3
BLOCK = 64
SHARD = 1024
SEED = 20
#: Rounds of the index permutation.
SHUFFLES = 16
_GROUPS = 4096
_RUN = 1 << 16


def permuted(index: Column, size: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0 .. size-1, chosen by the key (swap or not).

    In each round an index and its mirror image are swapped or left, by one bit
    of a hash of the larger, so any size is permuted without a table.
    """
    def one_round(x: Column, n: Column) -> Column:
        turn = F.pmod(F.xxhash64(n, F.lit(SEED), *key), size)
        other = F.pmod(turn + size - x, size)
        swap = F.xxhash64(F.greatest(x, other), n, *key).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(SHUFFLES)), index.cast("long"), one_round)


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size in words; no text."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
    )


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source: its number (by code point, null last), size and target.

    All sizes are shared by weight. A source stops at ``MOST_ROUNDS`` times its
    size; what is beyond goes to the others by weight until none is above. With
    sources in the order of size over weight, that is one level per prefix: the
    first k stop, the rest share the remainder, and the highest level holds.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("number") % len(WEIGHTS) + 1).cast("int"))
    rows = by_source.withColumn("number", number.cast("long")).withColumn("weight", weight)
    cap = MOST_ROUNDS * F.col("source_size")
    order = Window.orderBy(cap / F.col("weight"), "number")
    before, onward = (
        order.rowsBetween(Window.unboundedPreceding, -1),
        order.rowsBetween(Window.currentRow, Window.unboundedFollowing),
    )
    total = F.sum("source_size").over(Window.partitionBy())
    left = total - F.coalesce(F.sum(cap).over(before), F.lit(0))
    level = left / F.sum("weight").over(onward)
    rows = rows.withColumn("cap", cap).withColumn("level", level)
    # It rises with each source that stops and falls once one would not have had to.
    free = F.max("level").over(Window.partitionBy())
    target = F.least(F.col("cap").cast("double"), free * F.col("weight"))
    return rows.select("source", "number", "source_size", target.alias("target"))


def streams(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """Each document with the token span [start, end) it takes in its source's stream.

    The order is a hash of the id. Spark cannot tell how many rows an exploded
    sequence gives, so joins with what grows with the input say that they merge. A source is summed in groups of that hash, so
    no window holds more than a group of one source, however large that is.
    """
    order = F.xxhash64(F.lit(SEED), "doc_id", "size")
    rows = sizes.withColumn("at", order).withColumn("part", F.shiftrightunsigned("at", 64 - 12))
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "source", "part", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("part_start")
    )
    named = goals.select("source", "number", "source_size", "target")
    parts = parts.alias("p").join(named.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source"))).select(
        "g.*", "part", "part_start"
    )
    inside = Window.partitionBy("source", "part").orderBy("at", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    within = rows.withColumn("within", F.sum("size").over(inside))
    joined = within.alias("d").join(
        parts.alias("p").hint("merge"),
        F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.part") == F.col("p.part")),
    )
    end = F.col("part_start") + F.col("within")
    return joined.select(
        "d.doc_id", "d.source", "d.size", "p.number", "p.source_size", "p.target",
        (end - F.col("d.size")).alias("start"), end.alias("end"),
    )


def slots(goals: DataFrame, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """The mix: one row per output slot, with its shard and the block that fills it.

    number, round, block name the source, the walk through it and the block.
    Slots of a source come in runs, so a large source is many rows from the start.
    """
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    filled = goals.where("source_size > 0").withColumn("blocks", blocks)
    n = F.least(
        F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"),
        MOST_ROUNDS * F.col("blocks"),
    )
    filled = filled.withColumn("n", n)
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    filled = filled.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn(
        "all", F.sum("n").over(Window.partitionBy())
    ).where("n > 0")
    runs = filled.withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / _RUN))))
    # The number of tasks is said: by their size alone, a few narrow rows would be one.
    tasks = int(goals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = runs.repartition(tasks, "number", "run")
    last = F.least(F.col("n"), (F.col("run") + 1) * _RUN) - 1
    rows = runs.withColumn("j", F.explode(F.sequence(F.col("run") * _RUN, last)))
    rows = rows.withColumn("round", F.floor(F.col("j") / F.col("blocks")))
    place = permuted(F.col("first") + F.col("j"), F.col("all"), F.lit("slots"))
    return rows.select(
        "number", "round",
        permuted(F.col("j") % F.col("blocks"), F.col("blocks"), F.col("number"), F.col("round")).alias("block"),
        F.floor(place / shard).alias("shard"),
        (place % shard).alias("place"),
    )


def shard_counts(mix: DataFrame) -> DataFrame:
    """The drawn number of slots of each source in each shard."""
    return mix.groupBy("shard", "number").agg(F.count("*").alias("n_slots"))


def taken_pieces(spans: DataFrame, mix: DataFrame, block: int = BLOCK) -> DataFrame:
    """The words [from_word, to_word) of a document that a block holds, and who takes it."""
    pieces = spans.where("size > 0").withColumn("block", F.explode(
        F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))
    ))
    used = mix.groupBy("number", "block").agg(
        F.collect_list("round").alias("rounds"), F.min("shard").alias("first_shard")
    )
    low = F.greatest("start", F.col("block") * block) - F.col("start")
    high = F.least("end", (F.col("block") + 1) * block) - F.col("start")
    return pieces.join(used.hint("merge"), ["number", "block"]).select(
        "doc_id", "number", "start", "end", low.alias("from_word"), high.alias("to_word"), "rounds", "first_shard"
    )


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"):
    """The written sizes of the documents, their streams and the targets of the sources."""
    sizes = written(sized(docs, id_col, text_col, source_col), "mix-sizes")
    goals = written(targets(sizes), "mix-targets")
    return sizes, goals, streams(sizes, goals)


def mix(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, **columns: str) -> DataFrame:
    """One row per document: its words, its source's size and target, its words in the mix.

    Null and empty texts have size 0 and nothing is taken; a null source is a
    source of its own, the last; repeated rows each have a place in the stream.
    A document is taken at most ``MOST_ROUNDS`` times. Runs agree.
    """
    _, goals, spans = plan(docs, **columns)
    pieces = taken_pieces(spans, slots(goals, block, shard), block)
    words = (F.col("to_word") - F.col("from_word")) * F.size("rounds")
    per_doc = pieces.groupBy("number", "start", "end").agg(
        F.sum(words).alias("taken"), F.min("first_shard").alias("first_shard")
    )
    kept = spans.join(per_doc.hint("merge"), ["number", "start", "end"], "left")
    # An empty document shares its start and end with another empty one only.
    return kept.select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).alias("taken"), "first_shard",
    )


def cut(text: Column, taken: Column) -> Column:
    """The words of the taken spans, in order, with the blanks before them.

    The words are bound to a variable: as a column of their own they would be put into
    the inner function by the optimizer, and the text read again for each span.
    """
    words = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))

    def joined(found: Column) -> Column:
        return F.array_join(F.transform(taken, lambda r: F.array_join(F.slice(
            found, (r["from_word"] + 1).cast("int"), (r["to_word"] - r["from_word"]).cast("int")
        ), "")), "")

    return F.transform(F.array(words), joined)[0]


def mixed_documents(
    docs: DataFrame, block: int = BLOCK,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mix as rows with the columns of ``docs``: what each round takes of a document.

    A row holds the words of the taken blocks of one document in one round, with
    the blanks before them; a document all of whose blocks are taken stays whole,
    and one that is taken twice comes twice. Documents without words are in no
    block. Null sources are a source, repeated rows are rows of their own, other
    columns go along; ``n_chars``, if there, is counted anew.
    """
    _, goals, spans = plan(docs, id_col, text_col, source_col)
    pieces = taken_pieces(spans, slots(goals, block), block)
    place = ["number", "start", "end"]
    rounds = pieces.withColumn("round", F.explode("rounds")).groupBy(*place, "round").agg(
        F.array_sort(F.collect_list(F.struct("from_word", "to_word"))).alias("_taken")
    )
    same = Window.partitionBy("doc_id", "source", "size")
    numbered = spans.where("size > 0").withColumn("copy", F.row_number().over(same.orderBy("start")))
    chosen = numbered.join(rounds.hint("merge"), place).select("doc_id", "source", "size", "copy", "_taken")
    rows = docs.select(F.struct(*docs.columns).alias("_row")).select(
        "_row",
        F.col("_row")[id_col].alias("_id"), F.col("_row")[source_col].alias("_source"),
        F.regexp_count(F.coalesce(F.col("_row")[text_col], F.lit("")), F.lit(WORD)).cast("long").alias("_size"),
    )
    # Which have words is asked again, not counted: a filter by size would count the words of each text twice.
    rows = rows.where(F.col("_row")[text_col].rlike(WORD))
    copies = Window.partitionBy("_id", "_source", "_size").orderBy(F.xxhash64(F.col("_row")[text_col]))
    rows = rows.withColumn("_copy", F.row_number().over(copies))
    on = [
        rows[a].eqNullSafe(chosen[b])
        for a, b in (("_id", "doc_id"), ("_source", "source"), ("_size", "size"), ("_copy", "copy"))
    ]
    text = F.col("_row")[text_col]
    count = F.aggregate("_taken", F.lit(0).cast("long"), lambda n, r: n + r["to_word"] - r["from_word"])
    met = rows.join(chosen.hint("merge"), on)
    met = met.withColumn("_text", F.when(count == F.col("_size"), text).otherwise(cut(text, F.col("_taken"))))
    out = [F.col("_text").alias(c) if c == text_col else
           F.length("_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
           F.col("_row")[c].alias(c) for c in docs.columns]
    return met.select(*out)
