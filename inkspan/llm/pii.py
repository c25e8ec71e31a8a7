"""Personal data: expressions propose spans, checksums confirm them, context sets the score.

A kind has a finder that proposes spans, a test that confirms them (the Luhn sum of
a card, the remainder by 97 of a bank account, the range of an address part), a
prior score, and words that speak for it. One of these words within ``NEAR`` code
points of the span raises the score. Kinds whose form alone says little are only
reported from ``LEAST`` upwards, so they need their context.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspan.llm.common import by_slice, texts

#: Code points before and after a span in which a word of its context counts.
NEAR = 40
#: What a word of the context adds, and the least score of a span that is reported.
GAIN, LEAST = 0.3, 0.5

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    """Every second digit from the right is doubled, its digits are added; the sum ends in 0."""
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else 2 * digit - 9 * (digit > 4)
    return total % 10 == 0


def mod_97(account: str) -> bool:
    """The first four signs go last, letters count from 10; the number leaves 1 of 97."""
    left = 0
    for sign in account[4:] + account[:4]:
        value = int(sign, 36)
        left = (left * (10 if value < 10 else 100) + value) % 97
    return left == 1


def emails(text: str) -> Iterator[Span]:
    """Around each @ in turn, so that a long run without one is passed over once."""
    host = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
    stop, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > stop and text[start - 1] in local:
            start -= 1
        found = host.match(text, at + 1) if start < at else None
        if found:
            stop = found.end()
            yield start, stop
        at = text.find("@", max(stop, at + 1))


def addresses(text: str) -> Iterator[Span]:
    """Four parts of a dotted row of numbers at a time, none above 255."""
    for row in re.finditer(r"[0-9]++(?:\.[0-9]++)*+", text):
        parts, at = row[0].split("."), row.start()
        for four in (parts[i : i + 4] for i in range(0, len(parts) - 3, 4)):
            stop = at + sum(map(len, four)) + 3
            if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in four):
                yield at, stop
            at = stop + 1


def cards(text: str) -> Iterator[Span]:
    for found in re.finditer(r"[0-9](?:[\x20-]?[0-9])++", text):
        digits = found[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def phones(text: str) -> Iterator[Span]:
    for found in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", found[0])) <= 15:
            yield found.span()


def accounts(text: str) -> Iterator[Span]:
    """International bank accounts, written in one piece or in groups of four."""
    forms = r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b"
    for found in re.finditer(forms, text, re.ASCII):
        account = found[0].replace(" ", "")
        if 15 <= len(account) <= 34 and mod_97(account):
            yield found.span()


def social_numbers(text: str) -> Iterator[Span]:
    """Three, two and four digits, none of them all zero, of an area that is given out."""
    for found in re.finditer(r"\b([0-9]{3})-([0-9]{2})-([0-9]{4})\b", text, re.ASCII):
        area, group, serial = map(int, found.groups())
        if area not in (0, 666) and area < 900 and group and serial:
            yield found.span()


@dataclass(frozen=True)
class Kind:
    name: str
    find: Callable[[str], Iterator[Span]]
    prior: float
    context: tuple[str, ...]
    always: bool = False  # reported whatever its score


KINDS = (
    Kind("email", emails, 0.7, ("mail", "email", "contact", "write"), always=True),
    Kind("ip", addresses, 0.5, ("ip", "address", "server", "host"), always=True),
    Kind("card", cards, 0.6, ("card", "credit", "visa", "payment"), always=True),
    Kind("phone", phones, 0.6, ("phone", "tel", "call", "mobile", "fax"), always=True),
    Kind("iban", accounts, 0.7, ("iban", "bank", "account", "transfer")),
    Kind("ssn", social_numbers, 0.3, ("ssn", "social", "security", "taxpayer")),
)


def spans(text: str, kinds: tuple[Kind, ...] = KINDS) -> list[dict]:
    """The spans of a text by kind, as listed, and start; those of one kind do not overlap."""
    found = []
    for kind in kinds:
        near = re.compile(rf"\b(?:{'|'.join(kind.context)})\b", re.ASCII | re.IGNORECASE)
        for start, stop in kind.find(text):
            before, after = text[max(0, start - NEAR) : start], text[stop : stop + NEAR]
            score = kind.prior + GAIN * bool(near.search(before) or near.search(after))
            if kind.always or score >= LEAST:
                found.append({
                    "kind": kind.name, "start": start, "stop": stop,
                    "text": text[start:stop], "score": round(score, 2),
                })
    return found


def find(
    docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and ``spans`` (kind, start, stop, text, score; code points, end exclusive) per row.

    Null and empty texts have none. Repeated rows and null ids stay, each as a row
    of its own; other columns are not read. Every finder passes over a text of any
    length in linear time. One pass, no shuffle.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    one = pa.struct([
        ("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
        ("text", pa.string()), ("score", pa.float64()),
    ])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([spans(text, kinds) for text in texts(batch)], pa.list_(one))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "spans"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    fields = "kind: string, start: bigint, stop: bigint, text: string, score: double"
    return rows.mapInArrow(by_slice(work), f"doc_id {id_type}, spans array<struct<{fields}>>")


def masked(docs: DataFrame, found: Column, text_col: str = "text") -> Column:
    """The text with each span replaced by its kind in brackets; of spans that overlap, the first."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s.start, s.stop, s.kind)))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def put(done, s):
        cut = F.substring(text, (done.at + 1).cast("int"), (s.start - done.at).cast("int"))
        new = F.struct(s.stop.alias("at"), F.concat(done.out, cut, F.lit("["), s.kind, F.lit("]")).alias("out"))
        return F.when(s.start >= done.at, new).otherwise(done)

    rest = lambda done: F.concat(done.out, F.substring(text, (done.at + 1).cast("int"), F.length(text)))
    return F.aggregate(ordered, start, put, rest)


def digest(found: DataFrame, base: tuple[str, ...] = ("email", "ip", "card", "phone")) -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans with their scores."""

    def listed(which: Column, put=lambda s: F.concat_ws(":", s.kind, s.start, s.stop)) -> Column:
        return F.array_join(F.transform(which, put), ",")

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s.kind.isin(*kinds))

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base]
    return found.select(
        "doc_id", *counts, F.sha2(listed(of(*base)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        listed(F.col("spans"), lambda s: F.format_number(s.score, 2)).alias("scores"),
    )
