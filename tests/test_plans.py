import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from inkspan.functions.messages import notification_body
from inkspan.operators.embedding import HashingEmbedder
from inkspan.plans import vectorize
from inkspan.operators.integrity import verify_hashes
from inkspan.schemas import CHUNK, MANIFEST
from inkspan.sources import notifications
from inkspan.sources.files import parse_form_feed_text
from inkspan.plans.vectorize import read_chunks, read_outcomes
from inkspan.streaming.ingest import read_table

FILES = {"a.pdf": b"one|two\f \fthree", "b.pdf": b"four", "bad.pdf": b"\xff"}


class Picky(HashingEmbedder):
    def embed(self, texts):
        if "two" in texts:
            raise ValueError("cannot embed")
        return super().embed(texts)


def fill(folder, contents=FILES):
    Path(folder).mkdir(parents=True, exist_ok=True)
    for name, content in contents.items():
        (Path(folder) / name).write_bytes(content)


def table_rows(table):
    return sorted(
        (r.file_name.rsplit("/", 1)[-1], r.document_page, r.chunk_no, r.text)
        for r in table.collect()
    )


ROWS = [("a.pdf", 0, 0, "one"), ("a.pdf", 0, 1, "two"), ("a.pdf", 2, 2, "three"), ("b.pdf", 0, 0, "four")]


def test_folder_to_table_twice(spark, folder):
    fill(folder + "/in")
    for _ in range(2):
        failed = vectorize.vectorize_folder(
            spark, folder + "/in", parse_form_feed_text, folder + "/table", 7, size=3, separator="|"
        )
    assert [r.path.rsplit("/", 1)[-1] for r in failed.collect()] == ["bad.pdf"]
    table = read_table(spark, folder + "/table", CHUNK)
    assert table_rows(table) == ROWS
    assert {len(r.chunk_vector) for r in table.collect()} == {64}


def test_file_with_a_failing_chunk_is_left_out_whole(spark, folder):
    fill(folder + "/in")
    failed = vectorize.vectorize_folder(
        spark, folder + "/in", parse_form_feed_text, folder + "/table", 0,
        size=3, separator="|", factory=Picky,
    )
    assert sorted(r.path.rsplit("/", 1)[-1] for r in failed.collect()) == ["a.pdf", "bad.pdf"]
    assert table_rows(read_table(spark, folder + "/table", CHUNK)) == ROWS[3:]


def test_through_csv(spark, folder):
    pages = spark.createDataFrame(
        [("a.pdf", 0, "one|two"), ("a.pdf", 2, "three"), ("b.pdf", 0, "four")],
        "file_name string, page int, text string",
    )
    made = vectorize.vectorize_pages(pages, size=3, separator="|").filter("error IS NULL")
    vectorize.export_csv(made, folder + "/csv")
    short = made.limit(1).withColumn("chunk_vector", F.slice("chunk_vector", 1, 3))
    vectorize.export_csv(short, folder + "/csv/more")
    spark.read.text(folder + "/csv/more").write.mode("append").text(folder + "/csv")
    rejected = vectorize.import_csv(spark, folder + "/csv", 64, folder + "/table", 0)
    assert rejected.select(F.size("chunk_vector").alias("n")).collect()[0].n == 3
    assert table_rows(read_table(spark, folder + "/table", CHUNK)) == ROWS


def send(spark, folder, *keys, receive_count=1):
    listing = spark.createDataFrame([(k,) for k in keys], "key string")
    notifications.write_messages(
        listing.select(
            notifications.message_id("key").alias("message_id"),
            notification_body("bucket", "key").alias("body"),
            F.lit(receive_count).alias("receive_count"),
            F.timestamp_seconds(F.lit(0)).alias("ts"),
        ),
        folder + "/queue",
    )


def test_notifications_to_table(spark, folder):
    fill(folder + "/in", FILES | {"c.pdf": b"changed"})
    manifest = spark.createDataFrame(
        [("a.pdf", hashlib.md5(FILES["a.pdf"]).hexdigest()), ("c.pdf", "0" * 32)], MANIFEST
    )
    def consume():
        vectorize.consume_notifications(
            spark, folder + "/queue", "file://" + folder + "/in", manifest, parse_form_feed_text,
            folder + "/tables", folder + "/offsets", size=3, separator="|",
        )
        return sorted(
            (r.key, r.receive_count, r.route, r.error and r.error.split(":")[0])
            for r in read_outcomes(spark, folder + "/tables").collect()
        )

    send(spark, folder, "a.pdf", "a.pdf", "bad.pdf", "c.pdf", "late.pdf")
    assert consume() == [
        ("a.pdf", 1, "done", None),
        ("bad.pdf", 1, "retry", "UnicodeDecodeError"),
        ("c.pdf", 1, "retry", "file hash mismatch"),
        ("late.pdf", 1, "retry", "FileNotFoundError"),
    ]
    # What failed is in the queue again, with a higher count.
    fill(folder + "/in", {"late.pdf": b"four"})
    send(spark, folder, "a.pdf", receive_count=2)
    send(spark, folder, "c.pdf", receive_count=3)
    assert consume() == [
        ("a.pdf", 1, "done", None),
        ("bad.pdf", 1, "retry", "UnicodeDecodeError"),
        ("bad.pdf", 2, "retry", "UnicodeDecodeError"),
        ("c.pdf", 1, "retry", "file hash mismatch"),
        ("c.pdf", 3, "dead_letter", "file hash mismatch"),
        ("late.pdf", 1, "retry", "FileNotFoundError"),
        ("late.pdf", 2, "done", None),
    ]
    table = read_chunks(spark, folder + "/tables")
    assert table_rows(table) == ROWS[:3] + [("late.pdf", 0, 0, "four")]

    # The same content again gives no rows, changed content does.
    send(spark, folder, "late.pdf", receive_count=1)
    assert ("bad.pdf", 3, "dead_letter", "UnicodeDecodeError") in consume()
    assert table.count() == 4
    fill(folder + "/in", {"late.pdf": b"five"})
    send(spark, folder, "late.pdf", receive_count=1)
    consume()
    table = read_chunks(spark, folder + "/tables")
    assert [r[3] for r in table_rows(table)[3:]] == ["five", "four"]

    # Dead letters go back whole: one file is mended, the other dies again.
    fill(folder + "/in", {"bad.pdf": b"mended"})
    sent = vectorize.redrive(spark, folder + "/queue", folder + "/tables", 1)
    assert sent.count() == 2
    again = consume()
    assert ("bad.pdf", 1, "done", None) in again
    assert again.count(("c.pdf", 1, "retry", "file hash mismatch")) == 2
    table = read_chunks(spark, folder + "/tables")
    assert "mended" in [r[3] for r in table_rows(table)]
    assert vectorize.redrive(spark, folder + "/queue", folder + "/tables", 2).count() == 0


def test_a_consumer_that_fails_late_shows_nothing_of_its_batch(spark, folder, monkeypatch):
    fill(folder + "/in", {"a.pdf": b"one", "b.pdf": b"two"})
    manifest = spark.createDataFrame([], MANIFEST)
    place = folder + "/tables"

    def consume():
        vectorize.consume_notifications(
            spark, folder + "/queue", "file://" + folder + "/in", manifest, parse_form_feed_text,
            place, folder + "/offsets", size=3, separator="|",
        )

    send(spark, folder, "a.pdf")
    consume()
    send(spark, folder, "b.pdf")
    stage = vectorize.stage

    def breaks(rows, path, *rest):
        if path.endswith("outcomes"):
            rows = rows.withColumn("error", F.raise_error(F.lit("disk full")).cast("string"))
        return stage(rows, path, *rest)

    monkeypatch.setattr(vectorize, "stage", breaks)
    with pytest.raises(Exception, match="disk full"):
        consume()
    assert [r.file_name for r in read_chunks(spark, place).collect()] == ["a.pdf"]
    assert [r.key for r in read_outcomes(spark, place).collect()] == ["a.pdf"]
    monkeypatch.setattr(vectorize, "stage", stage)
    consume()
    assert sorted(r.file_name for r in read_chunks(spark, place).collect()) == ["a.pdf", "b.pdf"]
    assert sorted(r.key for r in read_outcomes(spark, place).collect()) == ["a.pdf", "b.pdf"]


def test_one_hash_per_key(spark):
    files = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "key string, content string")
    good = hashlib.md5(b"x").hexdigest()
    manifest = spark.createDataFrame([("a", good), ("a", good), ("b", good), ("b", "other"), ("c", None)], MANIFEST)
    found = verify_hashes(files, manifest).collect()
    assert {r.key: r.verified for r in found} == {"a": True, "b": False, "c": True} and len(found) == 3
