import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from inkspan.schemas import CHUNK, CHUNK_CSV
from inkspan.sources import exports, files, notifications, tables

TRICKY = [' lead', 'trail ', 'a,"b"\n c', '', 'back\\slash', "tab\t", "日本　", "'", '"', 'x\n\ny']


def fill(folder, **contents):
    for name, content in contents.items():
        path = Path(folder) / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)


def names(frame):
    return sorted(r.path.rsplit("/", 1)[-1] for r in frame.select("path").collect())


def test_folder_scan(spark, folder):
    fill(folder, **{"a.pdf": b"1", "b.PDF": b"2", "c.txt": b"3", "sub/d.pdf": b"4"})
    assert names(files.read_folder(spark, folder)) == ["a.pdf"]
    assert names(files.read_folder(spark, folder, ignore_case=True)) == ["a.pdf", "b.PDF"]


def test_pages_and_quarantine(spark, folder):
    fill(folder, **{"a.txt": "p0\fp1 é\f".encode(), "bad.txt": b"\xff\xfe", "none.txt": b""})
    scanned = files.read_folder(spark, folder, "txt")
    made = files.extract_pages(scanned, files.parse_form_feed_text).cache()
    good = files.good_pages(made).withColumn("file_name", F.substring_index("file_name", "/", -1))
    assert sorted(tuple(r) for r in good.collect()) == [
        ("a.txt", 0, "p0"), ("a.txt", 1, "p1 é"), ("a.txt", 2, ""),
    ]
    assert names(files.quarantine(made)) == ["bad.txt"]
    assert "UnicodeDecodeError" in files.quarantine(made).first().error
    with pytest.raises(Exception, match="UnicodeDecodeError"):
        files.extract_pages(scanned, files.parse_form_feed_text, on_error="fail").collect()
    with pytest.raises(ValueError):
        files.extract_pages(scanned, files.parse_form_feed_text, on_error="ignore")


def test_parse_is_tried_again(spark, folder):
    marker = Path(folder) / "tries"

    def flaky(content):
        tries = int(marker.read_text()) if marker.exists() else 0
        marker.write_text(str(tries + 1))
        if tries < 2:
            raise OSError("not yet")
        return [content.decode()]

    one = spark.createDataFrame([("p", b"x")], "path string, content binary")
    row = files.extract_pages(one, flaky, attempts=3).first()
    assert (row.text, row.error) == ("x", None)


def test_html_parsers_agree(spark):
    html = "<html><SCRIPT a='1'>x<b></script><p>A&amp;\n<b>B</b><!-- c\n --></p><style>s</style>\t語 </html>"
    frame = spark.createDataFrame([(html,)], "h string")
    native = frame.select(files.html_text("h").alias("t")).first().t
    assert native == "A&amp; B 語"
    assert files.parse_html(html.encode()) == [native]


def test_fetch(spark, folder):
    fill(folder, **{"in/a.pdf": b"abc"})
    keys = spark.createDataFrame([("in/a.pdf",), ("gone.pdf",), (None,)], "key string")
    got = {r.key: (r.content and bytes(r.content), r.error) for r in files.fetch_files(keys, folder).collect()}
    assert got["in/a.pdf"] == (b"abc", None)
    assert got["gone.pdf"][0] is None and "FileNotFoundError" in got["gone.pdf"][1]
    assert got[None] == (None, "no object key in the message")


@pytest.mark.parametrize("quote_all", [True, False])
def test_csv_keeps_texts(spark, folder, quote_all):
    rows = [(i, t) for i, t in enumerate(TRICKY)] + [(99, None)]
    frame = spark.createDataFrame(rows, "i int, t string")
    exports.write_csv(frame, folder + "/out", quote_all)
    back = exports.read_csv(spark, folder + "/out", frame.schema)
    assert sorted((r.i, r.t) for r in back.collect()) == rows
    assert all(r[exports.CORRUPT] is None for r in back.collect())


def test_chunk_csv_round_trip_and_bad_lines(spark, folder):
    at = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
    rows = [("f.pdf", 1, i, t or "x", "m", 2, 3, at, [0.1 * i, -1e-8]) for i, t in enumerate(TRICKY)]
    frame = spark.createDataFrame(rows, CHUNK)
    for zone, label in (("UTC", "UTC"), ("Asia/Tokyo", "JST")):
        path = f"{folder}/{label}"
        exports.write_csv(exports.chunks_as_text(frame, zone, label), path)
        back = exports.read_chunks_csv(spark, path).drop(exports.CORRUPT)
        assert back.schema.simpleString() == frame.schema.simpleString()
        assert sorted(back.collect()) == sorted(frame.collect())
    Path(f"{folder}/UTC/extra.csv").write_text(
        ",".join(CHUNK_CSV.fieldNames()) + "\nf,1,notanumber,t,m,1,1,2024-01-01 00:00:00 UTC,[1]\n"
    )
    back = exports.read_chunks_csv(spark, f"{folder}/UTC")
    assert back.count() == len(rows) + 1
    assert sum(r[exports.CORRUPT] is not None for r in back.collect()) == 1


def test_csv_by_file(spark, folder):
    frame = spark.createDataFrame([("a.pdf", "t"), ("b.pdf", "u")], "file_name string, t string")
    exports.write_csv(frame, folder + "/out", by_file=True)
    assert sorted(p.name for p in Path(folder, "out").glob("file_name=*")) == [
        "file_name=a.pdf", "file_name=b.pdf",
    ]


PAGES = [("d\\a.pdf", 1, "zwei"), ("d\\a.pdf", 0, "eins"), ("d\\a.pdf", 2, "drei")]


def test_json_export(spark, folder):
    pages = files.with_source(spark.createDataFrame(PAGES, "file_name string, page int, text string"))
    rows = exports.pages_as_json(pages).collect()
    assert [(r.file_name, r.page) for r in rows] == [("d/a.pdf", 0), ("d/a.pdf", 1), ("d/a.pdf", 2)]
    assert [json.loads(r.json) for r in rows] == [
        {"page_content": t, "metadata": {"source": "d/a.pdf", "page": i}}
        for i, t in enumerate(["eins", "zwei", "drei"])
    ]
    exports.write_json_lines(pages, folder + "/lines")
    assert spark.read.json(folder + "/lines").count() == 3


def test_text_export_by_page(spark, folder):
    pages = spark.createDataFrame(PAGES, "file_name string, page int, text string")
    rows = exports.pages_as_text(pages.repartition(3)).collect()
    assert "".join(r.text for r in rows) == "eins\n\nzwei\n\ndrei"
    assert [r.page for r in rows] == [0, 1, 2]
    exports.write_text(exports.pages_as_text(pages).coalesce(1), folder + "/txt")
    assert [r.value for r in spark.read.text(folder + "/txt", wholetext=True).collect()] == [
        "eins\n\n\nzwei\n\n\ndrei\n"
    ]


def test_table_life(spark, folder):
    name = "life_of_a_table"
    assert tables.drop_table(spark, name) is False
    assert tables.drop_filled_table(spark, name) is False
    schema = spark.createDataFrame([], "i int").schema
    for _ in range(2):
        tables.create_table(spark, name, schema, folder + "/t")
    assert tables.drop_filled_table(spark, name) is False
    tables.append_table(spark.createDataFrame([(1,)], "i int"), name)
    tables.append_table(spark.createDataFrame([(2,)], "i int"), name)
    assert spark.table(name).count() == 2
    assert tables.drop_filled_table(spark, name) is True
    assert not spark.catalog.tableExists(name)


def test_rows_of_a_foreign_table_are_not_deleted(spark, folder):
    spark.range(3).write.parquet(folder + "/theirs")
    spark.sql(f"CREATE TABLE a_foreign_table (id long) USING parquet LOCATION '{folder}/theirs'")
    assert tables.drop_table(spark, "a_foreign_table") and not spark.catalog.tableExists("a_foreign_table")
    assert spark.read.parquet(folder + "/theirs").count() == 3


def test_a_failing_rerun_keeps_the_rows_and_readers_keep_theirs(spark, folder):
    rows = spark.range(5)
    tables.append_folder(rows, folder + "/t", 1)
    before = tables.read_runs(spark, folder + "/t")
    broken = rows.select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        tables.append_folder(broken, folder + "/t", 1)
    assert tables.read_runs(spark, folder + "/t").count() == 5
    tables.append_folder(spark.range(7), folder + "/t", 1)
    assert before.count() == 5 and tables.read_runs(spark, folder + "/t").count() == 7
    tables.append_folder(spark.range(0), folder + "/t", 1)
    assert tables.read_runs(spark, folder + "/t").count() == 0
    run = Path(folder, "t", "ingest_id=1")
    assert len(list(run.glob("version=*"))) == 2  # the last and the one before; no half-written one
    with pytest.raises(ValueError):
        tables.read_runs(spark, folder + "/none")


def test_two_tables_are_published_together(spark, folder):
    first, second = f"{folder}/all/a", f"{folder}/all/b"
    versions = [tables.stage(spark.range(n), path, 4) for n, path in ((2, first), (3, second))]
    schema = "id long, ingest_id long"
    def counts():
        return [tables.read_runs(spark, p, spark.createDataFrame([], schema).schema, f"{folder}/all").count() for p in (first, second)]
    assert counts() == [0, 0]
    tables.publish(spark, *versions, home=f"{folder}/all")
    assert counts() == [2, 3]
    tables.publish(spark, tables.stage(spark.range(9), second, 4), home=f"{folder}/all")
    assert counts() == [2, 9]


def test_repeated_ingest_replaces_itself(spark, folder):
    def rows(*values):
        return spark.createDataFrame([(v,) for v in values], "i int")

    for run, values in ((1, (1, 2)), (2, (3,)), (1, (1, 2))):
        tables.append_folder(rows(*values), folder + "/t", run)
    assert sorted(tuple(r) for r in tables.read_runs(spark, folder + "/t").collect()) == [
        (1, 1), (2, 1), (3, 2),
    ]


def test_notifications(spark):
    listing = spark.createDataFrame(
        [("a.pdf", None, True), ("b.PDF", "in/b.pdf", True), ("c.txt", None, True), ("d.pdf", None, False)],
        "file_name string, object_name string, ok boolean",
    )
    sent = {r.message_group: json.loads(r.body) for r in notifications.notifications(
        listing, "bucket", uploaded="ok"
    ).collect()}
    assert sent == {
        name: {"Records": [{"s3": {"bucket": {"name": "bucket"}, "object": {"key": key}}}]}
        for name, key in (("a.pdf", "a.pdf"), ("b.PDF", "in/b.pdf"))
    }
    ids = listing.select(notifications.message_id("file_name", "object_name").alias("i"))
    assert ids.distinct().count() == 4


@pytest.mark.parametrize("name", ["a b.txt", "a#b.txt", "100%.txt", "文書.txt", "a?b&c=d.txt", "%20.txt"])
def test_fetch_of_any_name(spark, folder, name):
    place = Path(folder, "an odd #folder")
    place.mkdir()
    (place / name).write_bytes(b"content")
    (place / "a").write_bytes(b"another")
    keys = spark.createDataFrame([(name,), ("missing",), (None,)], "key string")
    for base in (str(place), f"file://{place}", f"file:{place}/"):
        found = {r.key: r for r in files.fetch_files(keys, base).collect()}
        assert bytes(found[name].content) == b"content" and found[name].error is None
        assert found["missing"].error and found[None].error


def test_folder_is_listed_by_tasks(spark, folder):
    """Files in parts and beside them, as Spark reads them; the driver plans no file."""
    fill(folder, **{"in/a b#%41.pdf": b"12", "in/é.pdf": b"", "in/.h.pdf": b"3", "in/_h.pdf": b"4", "in/s/d.pdf": b"5"})
    flat = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder + "/in")
    found = files.read_folder(spark, folder + "/in")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, flat.collect())) and found.columns == flat.columns
    one = files.read_folder(spark, folder + "/in/a b*.pdf", content=False)
    assert [r.length for r in one.collect()] == [2] and one.columns == flat.columns[:3]
    rows = spark.range(50).select(F.concat("id", F.lit(".pdf")).alias("key"), F.encode(F.col("id").cast("string"), "UTF-8").alias("content"))
    assert files.write_files(rows, folder + "/out", parts=4) == 50
    assert sorted(p.name for p in Path(folder, "out").iterdir()) == [f"part={n}" for n in range(4)]
    dealt = files.read_folder(spark, folder + "/out")
    assert sorted(r.content.decode() + ".pdf" for r in dealt.collect()) == names(dealt) == sorted(f"{n}.pdf" for n in range(50))
    assert "FileScan" not in dealt._jdf.queryExecution().toString()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_folder(spark, folder + "/none").collect()


def test_fetch_finds_files_in_parts(spark, folder):
    rows = spark.createDataFrame([(f"x {i}.pdf", b"%d" % i) for i in range(20)], "key string, content binary")
    files.write_files(rows, folder + "/out", parts=3)
    got = files.fetch_files(rows.select("key").unionByName(spark.createDataFrame([(None,)], "key string")), folder + "/out", 3)
    assert {r.key: r.content and bytes(r.content) for r in got.collect()} == {None: None, **{f"x {i}.pdf": b"%d" % i for i in range(20)}}
