"""Time functions. Instants are ``timestamp``; a zone appears only in display."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from inkspan.functions.text import _col

PATTERN = "yyyy-MM-dd HH:mm:ss"


def utc_instant(wall: Column | str) -> Column:
    """A zone-less time read as UTC."""
    return F.convert_timezone(
        F.lit("UTC"), F.current_timezone(), _col(wall).cast("timestamp_ntz")
    ).cast("timestamp")


def wall_time(instant: Column | str, zone: str = "Asia/Tokyo") -> Column:
    """The zone's clock reading at an instant, as ``timestamp_ntz``."""
    return F.convert_timezone(
        F.current_timezone(), F.lit(zone), _col(instant).cast("timestamp_ntz")
    )


def zoned_text(instant: Column | str, zone: str = "Asia/Tokyo", label: str = "JST") -> Column:
    """``yyyy-MM-dd HH:mm:ss JST``, whatever the session zone is."""
    return F.concat(
        F.date_format(wall_time(instant, zone), PATTERN), F.lit(" " + label)
    )


def unix_seconds(instant: Column | str) -> Column:
    return F.unix_seconds(_col(instant).cast("timestamp"))


def unix_text(seconds: Column | str, zone: str = "UTC") -> Column:
    """Unix seconds as text on the zone's clock."""
    return F.date_format(wall_time(F.timestamp_seconds(_col(seconds)), zone), PATTERN)


def parse_unix(text: Column | str) -> Column:
    """UTC text back to unix seconds."""
    return F.unix_seconds(utc_instant(F.to_timestamp_ntz(_col(text), F.lit(PATTERN))))
