"""File notifications: build them, write them, read them as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inkspan.functions.messages import notification_body
from inkspan.functions.text import has_suffix
from inkspan.schemas import ENVELOPE


def notifications(
    listing: DataFrame, bucket: str, extension: str = ".pdf", uploaded: str | None = None
) -> DataFrame:
    """(message_group, body): one message per matching file of ``listing``.

    ``listing`` has ``file_name`` and ``object_name`` (NULL means the file
    name). Files whose ``uploaded`` column is not true get no message. The file
    name is the message group, within which order holds.
    """
    sent = listing.filter(has_suffix("file_name", extension, ignore_case=True))
    if uploaded is not None:
        sent = sent.filter(F.col(uploaded))
    return sent.select(
        F.col("file_name").alias("message_group"),
        notification_body(bucket, "object_name", default="file_name").alias("body"),
    )


def message_id(*columns: str) -> Column:
    """An id that is the same each time the same message is built."""
    return F.md5(F.concat_ws("|", *columns))


def write_messages(envelopes: DataFrame, path: str, mode: str = "append") -> None:
    envelopes.select(*ENVELOPE.fieldNames()).write.mode(mode).json(path)


def read_messages(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Envelopes as a stream, at most ``max_files`` new files per micro-batch."""
    return (
        spark.readStream.schema(ENVELOPE)
        .option("maxFilesPerTrigger", max_files)
        .json(path)
    )
