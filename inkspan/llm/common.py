"""What the operators of this subpackage share: words, Arrow passes, written tables."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.session import shared_folder

T = TypeVar("T")

#: A word: a run of characters other than blank and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of one Arrow batch that a task works on at a time.
SLICE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written below ``spark.checkpoint.dir`` and read back: lineage ends here."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent(spark: SparkSession, value: T) -> Callable[[], T]:
    """A value for all tasks, and how a task gets it.

    It is pickled with the classes of this package that it is made of, since workers
    need no copy of the package.
    """
    bytes_sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(bytes_sent.value)


def text_of(column: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def by_slice(
    work: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = SLICE
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``mapInArrow`` function that hands ``work`` a few rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield work(batch.slice(at, rows))

    return run


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]
