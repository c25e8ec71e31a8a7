"""Folder scans and the expansion of raw files to pages."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from inkspan.functions.text import _col, basename, forward_slashes
from inkspan.session import file_system

# What is cut from HTML, in this order. The patterns mean the
# same in Java, Python and RE2.
HTML_INVISIBLE = r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->"
HTML_TAG = r"(?s)<[^>]*>"
HTML_SPACES = r"[ \t\n\f\r]+"

PARSED = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("error", T.StringType()),
])

FETCHED = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("error", T.StringType()),
])

FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

_LISTED = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("at", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("is_folder", T.BooleanType()),
])

BATCH_BYTES = 16 << 20
# Files of one part, where files are dealt to parts of a folder.
PART_FILES = 2000

Parser = Callable[[bytes], list[str]]


def read_folder(
    spark: SparkSession, folder: str, extension: str = "pdf", ignore_case: bool = False, content: bool = True
) -> DataFrame:
    """Files of one folder as (path, modificationTime, length, content).

    Tasks list the folder and then, each its share, the parts below it, folders named
    ``x=y`` as those of ``write_files``: the driver sees no file. Without ``content`` no
    file is opened. Empty files are left out, as Spark's own scan does. A store that Arrow
    does not know is listed by Spark, on the driver.
    """
    letters = (f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)
    glob = "*." + ("".join(letters) if ignore_case else extension)
    system, path = file_system(spark, folder)
    given = [(s.getPath().toString(), s.getModificationTime() * 1000, s.getLen(), s.isDirectory())
             for s in system.globStatus(path) or []]
    try:
        open_folder(given[0][0] if given else "")
    except (OSError, pa.ArrowException, TypeError, ValueError):
        given = []
    if not given:
        found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
        return found if content else found.drop("content")
    roots = [name for name, *_ in given]
    # Hadoop's own reading of the glob, for names as they are.
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    schema, whole = to_arrow_schema(_LISTED), to_arrow_schema(FILE)

    def inside(path: str) -> tuple[pa.fs.FileSystem, str]:
        root = next(r for r in roots if path == r or path.startswith(r.rstrip("/") + "/"))
        if root not in opened:
            opened[root] = open_folder(root)
        system, base = opened[root]
        return system, base + path[len(root.rstrip("/")):]

    opened: dict[str, tuple[pa.fs.FileSystem, str]] = {}

    def expand(deep: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wanted = re.compile(pattern, re.DOTALL)
            rows = (
                dict(zip(schema.names, row))
                for batch in batches
                for given in zip(*(column.to_pylist() for column in batch.columns))
                for row in (_listed(*inside(given[0]), given[0], deep) if given[3] else [given])
                if row[3] or wanted.fullmatch(row[0].rsplit("/", 1)[-1])
            )
            return _batches(rows, "path", schema)

        return run

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bytes_of(path: str) -> bytes:
            system, name = inside(path)
            with system.open_input_stream(name, compression=None) as stream:
                return stream.read()

        rows = (
            {**row, "content": bytes_of(row["path"])}
            for batch in batches for at in range(batch.num_rows) for row in batch.slice(at, 1).to_pylist()
        )
        return _batches(rows, "content", whole)

    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    first = spark.createDataFrame(given, "path string, at long, length long, is_folder boolean")
    parts = first.mapInArrow(expand(False), _LISTED).repartition(tasks, "path")
    found = parts.mapInArrow(expand(True), _LISTED).filter("length > 0").select(
        "path", F.timestamp_micros("at").alias("modificationTime"), "length"
    )
    return found.mapInArrow(read, FILE) if content else found


def _listed(system: pa.fs.FileSystem, inner: str, folder: str, deep: bool) -> Iterator[tuple[str, int, int, bool]]:
    """(path, microseconds of its change, length, is it a part) of a folder; ``deep``: of its parts too."""
    folder = folder.rstrip("/")
    for name, is_file, changed, length in _entries(system, inner):
        hidden = name.startswith(".") or name.endswith("._COPYING_") or name.startswith("_") and "=" not in name
        if hidden and not name.startswith(("_metadata", "_common_metadata")):  # as Spark has it
            continue
        if is_file or not deep and "=" in name:
            yield f"{folder}/{name}", changed // 10**6 * 1000, length, not is_file
        elif "=" in name:
            yield from _listed(system, f"{inner}/{name}", f"{folder}/{name}", deep)


def _entries(system: pa.fs.FileSystem, inner: str) -> Iterator[tuple[str, bool, int, int]]:
    if isinstance(system, pa.fs.LocalFileSystem):  # one by one, however many there are
        with os.scandir(inner or "/") as entries:
            for entry in entries:
                about = entry.stat()
                yield entry.name, entry.is_file(), about.st_mtime_ns, about.st_size
    else:
        for about in system.get_file_info(pa.fs.FileSelector(inner)):
            yield about.base_name, about.type == pa.fs.FileType.File, about.mtime_ns or 0, about.size or 0


def _part_of(parts: int) -> Column:
    """The part of its folder in which the file of a ``key`` lies."""
    return F.format_string("part=%d", F.pmod(F.xxhash64("key"), F.lit(parts))) if parts else F.lit("")


def fetch_files(keys: DataFrame, folder: str, parts: int = 0) -> DataFrame:
    """(key, content, error) for the files a ``key`` column names inside ``folder``.

    ``parts`` is what ``write_files`` was given.

    Every key is fetched once, by a task of its own share of the keys: a missing
    file is a row with ``error`` and the driver lists nothing.
    """
    schema = to_arrow_schema(FETCHED)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_folder(folder)
        rows = (
            dict(zip(schema.names, (key, *_read_file(system, f"{base}/{part}" if part else base, key))))
            for batch in batches
            for key, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        )
        return _batches(rows, "content", schema)

    tasks = keys.sparkSession.sparkContext.defaultParallelism
    wanted = keys.select("key").distinct().repartition(tasks, "key")
    return wanted.select("key", _part_of(parts)).mapInArrow(fetch, FETCHED)


def _batches(rows: Iterator[dict], large: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches that end once their ``large`` fields reach BATCH_BYTES."""
    batch, size = [], 0
    for row in rows:
        batch.append(row)
        size += 64 + len(row[large] or "")
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(batch, schema)
            batch, size = [], 0
    if batch:
        yield pa.RecordBatch.from_pylist(batch, schema)


# Schemes of Spark's file systems that Arrow knows by another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "": "file"}


def open_folder(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it.

    Only scheme and host are read as a URI. Names below are paths as they are, with
    blanks, ``#``, ``%`` or any letter.
    """
    scheme, mark, rest = folder.partition("://")
    if not mark:
        return pa.fs.LocalFileSystem(), folder.removeprefix("file:").rstrip("/")
    scheme, (host, _, inner) = _SCHEMES.get(scheme, scheme), rest.partition("/")
    if scheme == "file":
        return pa.fs.LocalFileSystem(), f"/{inner}".rstrip("/")
    system, base = pa.fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return system, f"{base.rstrip('/')}/{inner}".rstrip("/")


def _read_file(system, folder: str, key: str | None) -> tuple[bytes | None, str | None]:
    if key is None:
        return None, "no object key in the message"
    try:
        with system.open_input_stream(f"{folder}/{key}") as stream:
            return stream.read(), None
    except (OSError, pa.ArrowInvalid) as e:
        return None, f"{type(e).__name__}: {e}"


def write_files(rows: DataFrame, folder: str, parts: int = 0) -> int:
    """Write each row's ``content`` to the file that its ``key`` names; how many.

    With ``parts`` the files are dealt to so many folders below ``folder``, which
    ``read_folder`` reads as one and ``fetch_files`` finds.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_folder(folder)
        system.create_dir(base, recursive=True)
        made = {""}
        for batch in batches:
            for key, content, part in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
                home = f"{base}/{part}" if part else base
                if part not in made:
                    system.create_dir(home, recursive=True)
                    made.add(part)
                with system.open_output_stream(f"{home}/{key.as_py()}") as stream:
                    stream.write(content.as_py() or b"")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    written = rows.select("key", "content", _part_of(parts).alias("part")).mapInArrow(write, "n long")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def html_text(content: Column | str) -> Column:
    """Visible text of an HTML page, as one line. Entities stay as written."""
    visible = F.regexp_replace(_col(content), HTML_INVISIBLE, " ")
    spaced = F.regexp_replace(F.regexp_replace(visible, HTML_TAG, " "), HTML_SPACES, " ")
    return F.btrim(spaced)


def parse_html(content: bytes) -> list[str]:
    """The whole HTML file as one page."""
    visible = re.sub(HTML_INVISIBLE, " ", content.decode("utf-8"))
    return [re.sub(HTML_SPACES, " ", re.sub(HTML_TAG, " ", visible)).strip(" ")]


def parse_form_feed_text(content: bytes) -> list[str]:
    """UTF-8 text with a form feed between pages."""
    return content.decode("utf-8").split("\f") if content else []


def extract_pages(
    files: DataFrame, parser: Parser, attempts: int = 1, on_error: str = "quarantine"
) -> DataFrame:
    """(path, page, text, error) from (path, content): one row per page, from 0.

    A file that fails ``attempts`` times gives one row with ``error`` and no
    page; with ``on_error="fail"`` it fails the job. A file with no page gives
    no row.
    """
    if on_error not in ("quarantine", "fail"):
        raise ValueError(f"unknown on_error: {on_error}")
    schema = to_arrow_schema(PARSED)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row
            for batch in batches
            for path, content in zip(batch.column(0), batch.column(1))
            for row in _parse(parser, path.as_py(), content.as_py(), attempts, on_error)
        )
        return _batches(rows, "text", schema)

    return files.select("path", "content").mapInArrow(expand, PARSED)


def _parse(parser, path, content, attempts, on_error) -> list[dict]:
    error = None
    for _ in range(attempts):
        try:
            texts = parser(content)
            return [
                {"path": path, "page": i, "text": t, "error": None} for i, t in enumerate(texts)
            ]
        except Exception as e:  # a foreign parser; its failure becomes data
            if on_error == "fail":
                raise
            error = f"{type(e).__name__}: {e}"
    return [{"path": path, "page": None, "text": None, "error": error}]


def good_pages(extracted: DataFrame) -> DataFrame:
    """(file_name, page, text). The name is the full path: equal names in two
    folders stay two files."""
    return extracted.filter(F.col("error").isNull()).select(
        F.col("path").alias("file_name"), "page", "text"
    )


def quarantine(extracted: DataFrame) -> DataFrame:
    return extracted.filter(F.col("error").isNotNull()).select("path", "error")


def with_source(pages: DataFrame) -> DataFrame:
    """Pages as (file_name, page_content, metadata{source, page})."""
    return pages.select(
        basename(forward_slashes("file_name")).alias("file_name"),
        F.col("text").alias("page_content"),
        F.struct(
            forward_slashes("file_name").alias("source"), F.col("page").alias("page")
        ).alias("metadata"),
    )
