"""Split a page text into chunks, as one expression per row (no shuffle, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from inkspan.functions.text import is_blank, literal_pattern, strip, _col

_SPAN = "array<struct<first:int,end:int>>"
# Spans of the block that grows; a full one is set aside, so no long array is
# copied for each chunk.
_BLOCK = 512


def pieces(text: Column | str, separator: str) -> Column:
    """Non-empty parts between literal separators; no separator means characters."""
    text = _col(text)
    if separator == "":
        return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    return F.filter(F.split(text, literal_pattern(separator), -1), lambda p: p != "")


def chunk_array(
    text: Column | str, size: int = 1000, overlap: int = 0, separator: str = "\n\n"
) -> Column:
    """Join neighbouring pieces into chunks of at most ``size`` code points.

    A piece longer than ``size`` stays whole. With ``overlap``, a chunk starts
    with the last pieces of the one before, as long as they fit in ``overlap``
    and leave room for the next piece. Chunks are stripped, blank ones dropped.

    The fold runs over piece lengths and collects index spans, so no text is
    copied until the chunks are cut.
    """
    if size < 1:
        raise ValueError("size must be positive; use line_array for one chunk per line")
    if not 0 <= overlap <= size:
        raise ValueError("overlap must lie between 0 and size")

    def cut(parts: Column) -> Column:
        # A slice would copy all pieces for every chunk.
        def piece_range(s: Column) -> Column:
            return F.transform(F.sequence(s.first, s.end - 1), lambda i: F.get(parts, i))

        joined = F.transform(
            _spans(F.transform(parts, F.length), size, overlap, len(separator)),
            lambda s: strip(F.array_join(piece_range(s), separator)),
        )
        return F.filter(joined, lambda c: c != "")

    return _bind(pieces(text, separator), cut)


def page_chunk_array(
    text: Column | str, size: int = 1000, overlap: int = 0, separator: str = "\n\n"
) -> Column:
    """Chunks of a page; a page that yields none is its own chunk unless blank."""
    text = _col(text)
    return _bind(
        chunk_array(text, size, overlap, separator),
        lambda c: F.when(F.size(c) > 0, c)
        .when(is_blank(text), F.array().cast("array<string>"))
        .otherwise(F.array(text)),
    )


def line_array(text: Column | str) -> Column:
    """Every non-blank stripped line; a non-empty page without one is kept whole."""
    text = _col(text)
    lines = F.filter(
        F.transform(F.split(text, "\n", -1), strip), lambda line: line != ""
    )
    return _bind(
        lines,
        lambda c: F.when(F.size(c) > 0, c)
        .when(text == "", F.array().cast("array<string>"))
        .otherwise(F.array(text)),
    )


def _spans(lengths: Column, size: int, overlap: int, sep: int) -> Column:
    """Piece index ranges [first, end) of the chunks."""

    def length_with(total: Column, count: Column, length: Column) -> Column:
        return total + length + F.when(count > 0, F.lit(sep)).otherwise(F.lit(0))

    # A lambda's result is copied whole when it is bound to a name, so the spans
    # are never part of what is bound.
    def state(full: Column, block: Column, at: Column) -> Column:
        return F.struct(full.alias("full"), block.alias("block"), at.alias("at"))

    def place(first: Column, nxt: Column, total: Column) -> Column:
        return F.struct(first.alias("first"), nxt.alias("nxt"), total.alias("total"))

    def closed(acc: Column, at: Column) -> Column:
        """The state with one more span, and the place of the next chunk."""
        span = F.struct(acc["at"].first.alias("first"), acc["at"].nxt.alias("end"))
        # Of exactly the type of the others: else all of them are cast in each step.
        block = F.array_append(acc.block, span.cast(_SPAN[len("array<"):-1]))
        is_full = F.size(acc.block) >= _BLOCK - 1
        return state(
            F.when(is_full, F.array_append(acc.full, block)).otherwise(acc.full),
            F.when(is_full, F.array().cast(_SPAN)).otherwise(block),
            at,
        )

    def kept_suffix(at: Column, length: Column, lens: Column) -> Column:
        def drop_first(k: Column, _: Column) -> Column:
            count = at.nxt - k.first
            too_long = k.total > overlap
            no_room = (length_with(k.total, count, length) > size) & (k.total > 0)
            gone = F.get(lens, k.first) + F.when(count > 1, F.lit(sep)).otherwise(F.lit(0))
            return F.when(
                too_long | no_room,
                F.struct((k.first + 1).alias("first"), (k.total - gone).alias("total")),
            ).otherwise(k)

        return F.aggregate(
            F.sequence(at.first, at.nxt - 1),
            F.struct(at.first.alias("first"), at.total.alias("total")),
            drop_first,
        )

    def after_cut(at: Column, length: Column, lens: Column) -> Column:
        if overlap == 0:
            return place(at.nxt, at.nxt + 1, length)
        return _bind(kept_suffix(at, length, lens), lambda k: place(
            k.first, at.nxt + 1, length_with(k.total, at.nxt - k.first, length)
        ))

    def fold(lens: Column) -> Column:
        def step(acc: Column, length: Column) -> Column:
            at = acc["at"]
            count = at.nxt - at.first
            grown = length_with(at.total, count, length)
            return F.when(
                (count > 0) & (grown > size), closed(acc, after_cut(at, length, lens))
            ).otherwise(state(acc.full, acc.block, place(at.first, at.nxt + 1, grown)))

        def spans(acc: Column) -> Column:
            return F.flatten(F.array_append(acc.full, acc.block))

        return F.aggregate(
            lens,
            state(
                F.array().cast(f"array<{_SPAN}>"), F.array().cast(_SPAN),
                place(F.lit(0), F.lit(0), F.lit(0)),
            ),
            step,
            lambda acc: F.when(
                acc["at"].nxt > acc["at"].first, spans(closed(acc, acc["at"]))
            ).otherwise(spans(acc)),
        )

    return _bind(lengths, fold)


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), 0)
