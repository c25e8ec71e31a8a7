"""Build and read file notifications."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from inkspan.functions.text import _col
from inkspan.schemas import NOTIFICATION


def notification_body(bucket: str, key: Column | str, default: Column | str | None = None) -> Column:
    """JSON body for one file; ``default`` stands in where ``key`` is null."""
    key = _col(key) if default is None else F.coalesce(_col(key), _col(default))
    record = F.struct(
        F.struct(
            F.struct(F.lit(bucket).alias("name")).alias("bucket"),
            F.struct(key.alias("key")).alias("object"),
        ).alias("s3")
    )
    return F.to_json(F.struct(F.array(record).alias("Records")))


def event_keys(body: Column | str) -> Column:
    """The object keys of all records of a body."""
    records = F.from_json(_col(body), NOTIFICATION).Records
    return F.transform(records, lambda r: r.s3.object.key)


def event_key(body: Column | str) -> Column:
    """The object key of the first record; NULL when the body has none."""
    return F.get(event_keys(body), 0)
