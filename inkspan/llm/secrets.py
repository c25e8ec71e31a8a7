"""Secret scans over a trigram index, with DataFrame functions only.

Each rule is a regular expression. ``trigram_query`` derives from it which
trigrams a text must hold: alternatives, each a set of trigrams. The index holds,
for every trigram that some rule asks for, the documents in which it occurs.
Intersecting its postings gives the candidates of a rule, and only candidates
meet the expression itself. A rule without mandatory trigrams meets all texts.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspan.llm.common import text_of


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: Group that must have at least ``least`` code points.
    group: int = 0
    least: int = 0


RULES = (
    Rule("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                   r"([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36}"),
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
#: Kinds that ``base_sha256`` covers.
BASE = ("assign", "access", "hex")

_MOST = 64  # texts that a part of an expression may stand for before it counts as anything


def trigram_query(pattern: str) -> frozenset[frozenset[str]]:
    """Alternatives of trigrams, in lower case: a match holds all of at least one of them.

    The empty set means that nothing is mandatory and every text must be scanned.
    """
    parsed = re._parser.parse(pattern)
    choices = [frozenset()]
    for run in _runs(parsed):
        choices = [a | b for a, b in product(choices, run)]
    choices = set(choices)
    least = {a for a in choices if not any(b < a for b in choices)}
    return frozenset() if frozenset() in least else frozenset(least)


def _runs(items) -> list[list[frozenset[str]]]:
    """For each stretch of a sequence that stands for few texts, the trigrams of each text."""
    runs, texts = [], {""}
    for item in items:
        exact = _exact(item)
        more = {a + b for a, b in product(texts, exact)} if exact is not None else set()
        if exact is None or len(more) > _MOST:
            runs.append([_trigrams(t) for t in texts])
            texts = exact if exact is not None else {""}
        else:
            texts = more
    runs.append([_trigrams(t) for t in texts])
    return [list(set(run)) for run in runs if all(run)]


def _exact(item) -> set[str] | None:
    """All texts that a part can match, or None if there are too many."""
    kind, value = str(item[0]), item[1]
    if kind == "LITERAL":
        return {chr(value).lower()}
    if kind == "IN" and all(str(k) == "LITERAL" for k, _ in value):
        return {chr(v).lower() for _, v in value}
    if kind == "SUBPATTERN":
        return _sequence(value[-1])
    if kind == "BRANCH":
        return _union(_sequence(branch) for branch in value[1])
    if kind == "MAX_REPEAT" and value[1] <= 1:
        once = _sequence(value[2])
        return once if once is None or value[0] else once | {""}
    return None


def _sequence(items) -> set[str] | None:
    texts = {""}
    for item in items:
        exact = _exact(item)
        if exact is None or len(texts) * len(exact) > _MOST:
            return None
        texts = {a + b for a, b in product(texts, exact)}
    return texts


def _union(sets) -> set[str] | None:
    found: set[str] = set()
    for one in sets:
        if one is None:
            return None
        found |= one
    return found


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def asked_trigrams(rules: Sequence[Rule] = RULES) -> list[str]:
    return sorted({t for r in rules for option in trigram_query(r.pattern) for t in option})


def _key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(id_col, text_col).alias("doc")


def postings(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The index: trigram and doc, for each asked trigram and each document it is in.

    doc is a hash of id and text, so copies of a text under many ids are many
    keys. Lower case of all scripts is used, which can only add candidates.
    """
    lowered = docs.select(_key(id_col, text_col), F.lower(text_col).alias("lowered"))
    held = F.array_compact(F.array(*(
        F.when(F.contains("lowered", F.lit(t)), F.lit(t)) for t in asked_trigrams(rules)
    )))
    return lowered.select(F.explode(held).alias("trigram"), "doc")


def candidates(index: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc, rules: the bits of the rules that the intersected postings allow."""
    bit = {t: n for n, t in enumerate(asked_trigrams(rules))}
    if len(bit) > 63:
        raise ValueError(f"{len(bit)} trigrams asked for; at most 63 in one pass")
    place = F.coalesce(*(F.when(F.col("trigram") == t, F.lit(1 << n)) for t, n in bit.items()))
    found = index.groupBy("doc").agg(F.bit_or(place.cast("long")).alias("held"))
    bits = F.lit(0)
    for n, rule in enumerate(rules):
        options = [sum(1 << bit[t] for t in option) for option in trigram_query(rule.pattern)]
        if options:
            fits = [F.col("held").bitwiseAND(F.lit(o).cast("long")) == o for o in options]
            allowed = fits[0]
            for more in fits[1:]:
                allowed = allowed | more
            bits = bits + F.when(allowed, F.lit(1 << n)).otherwise(0)
    return found.select("doc", bits.alias("rules")).where("rules != 0")


def _hits(number: int, rule: Rule) -> Column:
    """All matches of a rule as (kind, place, gap before, length, long enough)."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    zipped = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("before"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
    )
    found = F.transform(zipped, lambda x, i: F.struct(
        F.lit(number).alias("kind"),
        i.alias("place"),
        F.length(x["before"]).cast("long").alias("gap"),
        F.length(x["hit"]).cast("long").alias("long"),
        (F.length(x["part"]) >= rule.least).alias("enough"),
    ))
    needed = bool(trigram_query(rule.pattern))
    asked = F.col("rules").bitwiseAND(F.lit(1 << number)) != 0 if needed else F.lit(True)
    return F.when(asked & F.col("text").rlike(rule.pattern), found).otherwise(
        F.array().cast("array<struct<kind:int,place:int,gap:bigint,long:bigint,enough:boolean>>")
    )


def scan(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id and found, its spans by start and then rule.

    A span is (start, kind, end) in code points, end exclusive. Null texts are
    empty and have none; null ids and repeated rows stay rows of their own.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    allowed = candidates(postings(rows, rules), rules)
    # A merge keeps the rows of a task in the order of doc, so a repeated task numbers them alike.
    joined = rows.select("*", _key("doc_id", "text")).join(allowed.hint("merge"), "doc", "left")
    joined = joined.select("doc_id", "text", F.coalesce("rules", F.lit(0)).alias("rules"))
    hits = joined.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.concat(*(_hits(n, rule) for n, rule in enumerate(rules))).alias("hits"),
    ).select("row", "doc_id", F.explode_outer("hits").alias("hit")).select("row", "doc_id", "hit.*")
    before = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = hits.repartition("row").withColumn("end", F.sum(F.col("gap") + F.col("long")).over(before))
    span = F.struct((F.col("end") - F.col("long")).alias("start"), "kind", "end")
    grouped = placed.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.collect_list(F.when(F.col("enough") & F.col("long").isNotNull(), span)).alias("found"),
    )
    return grouped.select("doc_id", F.array_sort("found").alias("found"))


def digest(scanned: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Counts per base kind, the hash of the base spans and all spans as text."""
    number = {rule.kind: n for n, rule in enumerate(rules)}
    names = F.array(*(F.lit(rule.kind) for rule in rules))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
        )), ",")

    def counted(kind: str) -> Column:
        of = F.filter("found", lambda s: s["kind"] == number[kind])
        return F.size(of).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"].isin(*(number[k] for k in BASE)))
    return scanned.select(
        "doc_id",
        *(counted(kind) for kind in BASE),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )
