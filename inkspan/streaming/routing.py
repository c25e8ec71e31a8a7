"""Routes of message deliveries that arrive as a stream, and the redrive of dead letters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from inkspan.operators.routing import DEAD_LETTER, MAX_ATTEMPTS, RETRY, route_deliveries
from inkspan.schemas import FAILURE_REASON
from inkspan.sources.tables import read_runs
from inkspan.streaming.ingest import put, read_table, run

REDRIVEN, KEPT = "redriven", "kept"


def route_stream(
    deliveries: DataFrame,
    key: str,
    ts: str,
    tie: str,
    failed: str,
    path: str,
    checkpoint: str,
    max_attempts: int = MAX_ATTEMPTS,
    every: str | None = None,
    **options,
):
    """File each delivery with ``attempt``, ``route`` and ``failure_reason``.

    Below ``path``: ``routes``, partitioned by run and route, and ``open``, the
    number of open failures per key after each run. A success or a dead letter
    closes a key, so ``open`` holds only keys that wait for a retry.

    A run reads the open failures that the run before it left and puts them in
    front of the new deliveries. So a repeated run gives the same rows, and a
    hot key is cut into blocks as in ``route_deliveries``. Rows of a key count
    in (ts, tie) order inside a run; ``tie`` must not be NULL.
    """
    spark = deliveries.sparkSession
    routes, opened = f"{path}/routes", f"{path}/open"
    open_schema = T.StructType([
        deliveries.schema[key], T.StructField("open_failures", T.IntegerType()),
    ])

    def handle(batch: DataFrame, batch_id: int) -> None:
        waiting = read_table(spark, opened, open_schema).filter(F.col("ingest_id") == batch_id - 1)
        # An open failure stands as a delivery without ts and tie, first in its key.
        earlier = waiting.select(
            key, F.lit(True).alias(failed), F.explode(F.sequence(F.lit(1), "open_failures"))
        ).drop("col")
        routed = route_deliveries(
            batch.unionByName(earlier, allowMissingColumns=True),
            key, ts, tie, failed, max_attempts, **options,
        ).persist()
        try:
            reason = F.when(F.col("route") == DEAD_LETTER, F.lit(FAILURE_REASON))
            now = routed.filter(F.col(tie).isNotNull())
            put(now.withColumn("failure_reason", reason), batch_id, routes, "route")
            still_open = F.when(F.col("route") == RETRY, F.col("attempt")).otherwise(F.lit(0))
            latest = F.struct(F.col(tie).isNotNull(), ts, tie, "attempt")
            left = routed.groupBy(key).agg(F.max_by(still_open, latest).alias("open_failures"))
            put(left.filter("open_failures > 0"), batch_id, opened)
        finally:
            routed.unpersist()

    return run(deliveries, handle, checkpoint, every)


def read_routes(spark: SparkSession, path: str) -> DataFrame:
    return read_runs(spark, f"{path}/routes")


def redrive_stream(
    spark: SparkSession,
    letters: str,
    schema: T.StructType,
    process: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    message_id: str = "message_id",
    every: str | None = None,
):
    """Work off new dead letters; file each as redriven or kept below ``path``.

    ``process`` takes a batch of letters and gives the ids that succeeded.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        succeeded = process(batch).select(message_id).distinct().withColumn("ok", F.lit(True))
        outcome = F.when(F.col("ok"), F.lit(REDRIVEN)).otherwise(F.lit(KEPT))
        filed = batch.join(succeeded, message_id, "left").withColumn("outcome", outcome)
        put(filed.drop("ok"), batch_id, path, "outcome")

    return run(spark.readStream.schema(schema).parquet(letters), handle, checkpoint, every)
