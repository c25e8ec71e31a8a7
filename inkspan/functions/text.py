"""String functions: strip, paths, suffixes, previews."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The code points Python's str.strip() removes.
WHITESPACE = "".join(map(chr, [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0,
    0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007,
    0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))


def strip(text: Column | str) -> Column:
    """Remove Unicode whitespace at both ends. ``trim`` removes spaces only."""
    return F.btrim(_col(text), F.lit(WHITESPACE))


def is_blank(text: Column | str) -> Column:
    return strip(text) == ""


def basename(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def stem(path: Column | str) -> Column:
    """The path without its last extension; dots that lead a name do not count."""
    return F.regexp_replace(_col(path), r"(?s)^((?:.*/)?\.*[^/.][^/]*)\.[^./]*\z", "$1")


def with_extension(path: Column | str, extension: str) -> Column:
    return F.concat(stem(path), F.lit(extension))


def forward_slashes(path: Column | str) -> Column:
    return F.translate(_col(path), "\\", "/")


def has_suffix(name: Column | str, suffix: str, ignore_case: bool = False) -> Column:
    name = _col(name)
    if ignore_case:
        return F.lower(name).endswith(suffix.lower())
    return name.endswith(suffix)


def preview(text: Column | str, n: int = 100) -> Column:
    return F.substring(_col(text), 1, n)


def literal_pattern(text: str) -> str:
    """A Java regular expression that matches ``text`` itself."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
