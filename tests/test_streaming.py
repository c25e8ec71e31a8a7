import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from inkspan.schemas import ENVELOPE
from inkspan.sources import notifications
from inkspan.streaming import ingest, routing, timed
from test_operators import replay

EVENT = "id long, key string, at long, failed boolean, ts timestamp"


def messages(spark, ids, ts=0):
    return spark.createDataFrame(
        [(str(i), f'{{"n":{i}}}', 1, None) for i in ids], ENVELOPE
    ).withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000 + ts)))


def consume(spark, folder, max_files=1000, key=("message_id",)):
    stream = notifications.read_messages(spark, folder + "/queue", max_files)
    stream = stream.select("message_id", "body")
    ingest.run(
        stream, lambda b, i: ingest.ingest(b, i, folder + "/table", key), folder + "/offsets"
    )
    return ingest.read_table(spark, folder + "/table", stream.schema)


def ids_in(table):
    return sorted(int(r.message_id) for r in table.select("message_id").collect())


@pytest.mark.parametrize("max_files", [1, 1000])
def test_each_message_once(spark, folder, max_files):
    for part in (range(0, 5), range(3, 8), [7, 7, 8]):
        notifications.write_messages(messages(spark, part).coalesce(1), folder + "/queue")
    table = consume(spark, folder, max_files)
    assert ids_in(table) == list(range(9))
    assert table.select("ingest_id").distinct().count() == (3 if max_files == 1 else 1)


def test_restart_and_redelivery(spark, folder):
    notifications.write_messages(messages(spark, range(5)), folder + "/queue")
    assert ids_in(consume(spark, folder)) == list(range(5))
    assert ids_in(consume(spark, folder)) == list(range(5))
    notifications.write_messages(messages(spark, range(3, 8)), folder + "/queue")
    assert ids_in(consume(spark, folder)) == list(range(8))


def test_replayed_batches(spark, folder):
    path = folder + "/table"
    batches = {0: [1, 2, 2], 1: [2, 3]}
    for batch_id in (0, 0, 1, 1, 0):
        ingest.ingest(messages(spark, batches[batch_id]), batch_id, path, ("message_id",))
    table = ingest.read_table(spark, path, ENVELOPE)
    assert ids_in(table) == [1, 2, 3]
    assert ids_in(table.filter("ingest_id = 0")) == [1, 2]


def test_failed_batch_is_handed_over_again(spark, folder):
    notifications.write_messages(messages(spark, range(4)), folder + "/queue")
    stream = notifications.read_messages(spark, folder + "/queue")
    calls = []

    def fails_once(batch, batch_id):
        calls.append(batch_id)
        ingest.ingest(batch, batch_id, folder + "/table", ("message_id",))
        if len(calls) == 1:
            raise RuntimeError("after the write, before the commit")

    with pytest.raises(Exception, match="before the commit"):
        ingest.run(stream, fails_once, folder + "/offsets")
    ingest.run(stream, fails_once, folder + "/offsets")
    assert calls == [0, 0]
    assert ids_in(ingest.read_table(spark, folder + "/table", ENVELOPE)) == list(range(4))


def test_repeats_within_the_horizon(spark, folder):
    notifications.write_messages(messages(spark, range(4)).coalesce(1), folder + "/queue")
    later = messages(spark, range(2, 6), ts=-90 * 24 * 3600)
    notifications.write_messages(later.coalesce(1), folder + "/queue")
    stream = ingest.unique_messages(notifications.read_messages(spark, folder + "/queue", 1))
    ingest.run(stream, lambda b, i: ingest.put(b, i, folder + "/table"), folder + "/offsets")
    assert ids_in(ingest.read_table(spark, folder + "/table", stream.schema)) == list(range(6))


@pytest.mark.parametrize("runs, block", [(1, 1000), (4, 1000), (2, 7)])
def test_open_failures_pass_from_run_to_run(spark, folder, runs, block):
    rng = random.Random(9)
    events = [(i, f"k{rng.randrange(4)}", i, rng.random() < 0.7) for i in range(80)]
    size = len(events) // runs
    for run in range(runs):
        part = events[run * size : (run + 1) * size]
        rng.shuffle(part)
        spark.createDataFrame(part, "id long, key string, at long, failed boolean").withColumn(
            "ts", F.timestamp_seconds("at")
        ).write.mode("append").json(folder + "/queue")
        stream = spark.readStream.schema(EVENT).json(folder + "/queue")
        routing.route_stream(
            stream, "key", "ts", "id", "failed", folder + "/routed", folder + "/offsets",
            rows_per_block=block,
        )
    table = routing.read_routes(spark, folder + "/routed")
    assert {r.id: (r.attempt, r.route) for r in table.collect()} == replay(events)
    reasons = {(r.route, r.failure_reason) for r in table.collect()}
    assert reasons <= {
        ("done", None), ("retry", None), ("dead_letter", "Exceeded max retry attempts"),
    }


def test_a_batch_reads_its_own_parts_of_the_ledger(spark, folder):
    path = folder + "/table"
    rows = spark.range(500).select(F.col("id").cast("string").alias("message_id"), F.lit("k").alias("key"))
    ingest.ingest(rows, 0, path, ("message_id",))
    some = rows.filter("message_id IN ('3', '77')")
    asked = ingest.ledger(spark, path, rows.schema, some, ("message_id",), 1)
    scanned = {name.split("key_bucket=")[1].split("/")[0] for name in asked.inputFiles()}
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "key_bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    touched = {str(r[0]) for r in some.select(ingest.bucket_of("message_id")).collect()}
    assert {str(r[0]) for r in asked.select(ingest.bucket_of("message_id")).distinct().collect()} == touched < scanned
    ingest.ingest(some.unionByName(spark.createDataFrame([("new", "k")], rows.schema)), 1, path, ("message_id",))
    assert ingest.read_table(spark, path, rows.schema).count() == 501


def test_timed_retries_wait_and_close(spark, folder):
    schema = "file string, message_id string, ts timestamp, body string"
    def send(*rows):
        frame = spark.createDataFrame([(f, m, s, b) for f, m, s, b in rows], "file string, message_id string, s long, body string")
        frame.select("file", "message_id", F.timestamp_seconds("s").alias("ts"), "body").write.mode("append").json(folder + "/queue")

    def consume():
        stream = spark.readStream.schema(schema).json(folder + "/queue")
        tried = timed.timed_retries(stream, lambda body, attempt: attempt > int(body), "file", visibility=30, lateness="0 seconds")
        ingest.run(tried, lambda batch, n: ingest.put(batch, n, folder + "/out"), folder + "/offsets")
        found = ingest.read_table(spark, folder + "/out", tried.schema)
        return sorted((r.file, r.message_id, r.attempt, int(r.at.timestamp()), r.route) for r in found.select(
            "file", "message_id", "attempt", "at", "route").collect())

    with timed.rocksdb(spark):
        send(("a", "1", 100, "1"), ("a", "2", 110, "0"), ("b", "3", 120, "5"))
        first = [("a", "1", 1, 100, "retry"), ("a", "2", 1, 110, "done"), ("b", "3", 1, 120, "retry")]
        assert consume() == first  # nothing is tried before its time
        send(("c", "4", 140, "0"))
        second = [*first, ("a", "1", 2, 130, "done"), ("c", "4", 1, 140, "done")]
        assert consume() == sorted(second)
        send(("c", "5", 1000, "0"))
        assert consume() == sorted([*second, ("b", "3", 2, 150, "retry"), ("b", "3", 3, 180, "dead_letter"), ("c", "5", 1, 1000, "done")])
        send(("c", "6", 5000, "0"))
        assert len(consume()) == 9  # what is closed is not tried again


def test_timed_retries_set_one_timer_for_a_file():
    """Messages of a file that fail together are read from state once, not once for each."""
    class State(dict):
        reads = 0

        def iterator(self):
            self.reads += 1
            return iter(list(self.items()))

        updateValue, removeKey = dict.__setitem__, dict.__delitem__

    class Handle:
        def __init__(self):
            self.timers, self.state = set(), State()

        def getMapState(self, *_):
            return self.state

        def registerTimer(self, at):
            self.timers.add(at)

    class Now:
        def __init__(self, at):
            self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: at

    given, handle = timed._Deliveries(lambda body, attempt: attempt > int(body), "file", "id", "ts", 3, 30), Handle()
    given.init(handle)
    frame = pd.DataFrame({"file": "a", "id": range(500), "ts": pd.to_datetime(range(500), unit="s"), "body": ["1", "5"] * 250})
    found = list(given.handleInputRows(("a",), iter([frame]), Now(0)))
    assert sum(map(len, found)) == len(handle.state) == 500 and handle.timers == {30_000}
    # At 300 s, 271 messages have had a second attempt, and 121 of those that fail on a third.
    later = pd.concat(given.handleExpiredTimer(("a",), Now(300_000), Now(30_000)))
    assert later.groupby("attempt").size().to_dict() == {2: 271, 3: 120} and handle.state.reads == 1
    assert handle.timers == {30_000, 301_000} and len(handle.state) == 500 - 136 - 120
    rest = pd.concat(given.handleExpiredTimer(("a",), Now(10**9), Now(301_000)))
    assert not handle.state and len(rest) == 500 + 250 - 391 and set(rest["route"]) == {"retry", "done", "dead_letter"}
