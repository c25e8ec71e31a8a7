"""Quality rules: a ledger of measurements and failure bits, and policies over it.

A document is measured once. ``ledger`` stores the measurements and one bit per
failed rule; a policy is a version with a mask of the rules it applies, so that
policies and ablations are bit operations on the ledger and never read text again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspan.llm.common import by_slice, texts

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


#: Every rule: the condition, over the measurements, under which it fails.
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbol_share": "2 * n_symbols > word_chars",
    "long_words": "word_chars > 60 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
}

#: Bit of each rule, by its place in the list; new rules go to the end.
BITS = {name: 1 << place for place, name in enumerate(RULES)}


def mask(*rules: str) -> int:
    return sum(BITS[rule] for rule in rules)


#: Versioned policies: the rules whose failure rejects a document.
POLICIES: Mapping[str, int] = {
    "base": mask("few_words", "repeated_words"),
    "v1": mask("few_words", "repeated_words", "symbol_share"),
    "v2": mask(*BITS),
}


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    words = text.encode().split()  # bytes are split at blanks and controls 9 to 13 only
    lines = Counter(line for line in text.split("\n") if line.strip(BLANKS))
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        lines.total(),
        lines.total() - len(lines),
        _repeated(words),
    )


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a window of five found at least twice."""
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    found, inside = Counter(windows), bytearray(len(words))
    for at, window in enumerate(windows):
        if found[window] > 1:
            inside[at : at + WINDOW] = b"\1" * WINDOW
    return sum(inside)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, every measurement and the bits of failed rules.

    Null and empty texts have no words and fail the rules that say so; repeated
    rows and null ids stay, each as a row of its own. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    fields = ", ".join(f"{name} long" for name in MEASURES)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = zip(*map(measure, texts(batch)), strict=True)
        columns = [pa.array(x, pa.int64()) for x in found]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *MEASURES])

    kind = rows.schema["doc_id"].dataType.simpleString()
    measured = rows.mapInArrow(by_slice(work), f"doc_id {kind}, {fields}")
    failed = sum(
        (F.when(F.expr(rule), F.lit(BITS[name])).otherwise(0) for name, rule in RULES.items()), F.lit(0)
    )
    return measured.withColumn("failures", failed.cast("long"))


def fails(policy: int) -> Column:
    return F.col("failures").bitwiseAND(F.lit(policy)) != 0


def apply_policy(rows: DataFrame, version: str) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return rows.withColumn("kept", ~fails(POLICIES[version]))


def ablations(rows: DataFrame, version: str) -> DataFrame:
    """For each rule of a policy: what it rejects, rejects alone, and the yield without it.

    The ledger is first counted by its bits, so at most one row per combination
    of failures is left for the rest.
    """
    policy = POLICIES[version]
    counts = rows.groupBy(F.col("failures").bitwiseAND(F.lit(policy)).alias("bits")).agg(
        F.count("*").alias("n")
    )

    def documents(which: Column) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))

    applied = [(name, bit) for name, bit in BITS.items() if policy & bit]
    found = counts.agg(*(
        F.struct(
            F.lit(name).alias("rule"),
            documents(F.col("bits").bitwiseAND(F.lit(bit)) != 0).alias("n_rejected"),
            documents(F.col("bits") == bit).alias("n_only"),
            documents(F.col("bits").bitwiseAND(F.lit(policy & ~bit)) == 0).alias("n_kept_without"),
        ).alias(name)
        for name, bit in applied
    ))
    return found.select(F.inline(F.array(*(F.col(name) for name, _ in applied))))
