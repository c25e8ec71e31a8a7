"""The chunk table: create, append, replace and publish runs, read, drop.

A table of ingest runs is a folder that holds each run as ``ingest_id=N/version=V``.
A version is written whole before anybody reads it: what counts is said by a small
note below ``_published``, put in place by one rename. Replacing a run is writing
another version and its note, so readers see the old rows or the new ones, a job
that fails changes nothing, and one note can publish several tables together.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from inkspan.schemas import CHUNK
from inkspan.session import delete_folder, file_system, rename_file, write_file

BATCH_SIZE = 1000
#: Property of the tables whose rows ``drop_table`` may delete.
OWNED = "inkspan.owned"


def create_table(
    spark: SparkSession, name: str, schema: StructType = CHUNK, location: str | None = None
) -> None:
    """Create an empty Parquet table unless it exists; its rows are this package's to drop."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet{place}"
        f" TBLPROPERTIES ('{OWNED}' = 'true')"
    )


def append_table(rows: DataFrame, name: str) -> None:
    """Append in one commit: all rows of the job or none."""
    rows.write.insertInto(name)


@dataclass(frozen=True)
class Version:
    """Rows of a run that are written but not published yet."""

    table: str
    ingest_id: int | str
    name: str


def stage(rows: DataFrame, path: str, ingest_id: int | str, *more_partitions: str) -> Version:
    """Write a run of the table at ``path`` without touching what is published."""
    version = Version(path.rstrip("/"), ingest_id, uuid.uuid4().hex)
    writer = rows.write.partitionBy(*more_partitions) if more_partitions else rows.write
    writer.parquet(_folder(version))
    return version


def publish(spark: SparkSession, *versions: Version, home: str | None = None) -> None:
    """Let these versions of one run stand in place of the run's rows, all at once.

    ``home`` keeps the notes, by default the table itself; tables that are published
    together need a folder above them, and are read by it too. The version before
    stays for those who read it now; what is older, or was never published, goes.
    """
    home = _home(versions[0].table, home)
    ingest_id, = {v.ingest_id for v in versions}
    notes = _notes(spark, home).get(str(ingest_id), [])
    last = _content(spark, notes[-1][1]) if notes else {}
    now = last | {_relative(v.table, home): v.name for v in versions}
    number = notes[-1][0] + 1 if notes else 0
    staged = f"{home}/_published/.{uuid.uuid4().hex}"
    write_file(spark, staged, json.dumps(now))
    rename_file(spark, staged, f"{home}/_published/{ingest_id}.{number}")
    for _, old in notes[:-1]:
        delete_folder(spark, old)
    for version in versions:
        kept = {version.name, last.get(_relative(version.table, home))}
        run = f"{version.table}/ingest_id={ingest_id}"
        for name in _names(spark, run):
            if name.startswith("version=") and name.removeprefix("version=") not in kept:
                delete_folder(spark, f"{run}/{name}")


def read_runs(spark: SparkSession, path: str, schema: StructType | None = None, home: str | None = None) -> DataFrame:
    """The published rows of all runs, as they stand at this moment, with ``ingest_id``.

    The notes name the folders to read, one for each run, so no other file is listed.
    """
    path, home = path.rstrip("/"), _home(path, home)
    name, folders = _relative(path, home), []
    for ingest_id, notes in _notes(spark, home).items():
        content = _content(spark, notes[-1][1])
        if name in content:
            folders.append(_folder(Version(path, ingest_id, content[name])))
    if not folders and schema is None:
        raise ValueError(f"no run of {path} is published")
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", path)
    rows = (reader if schema is None else reader.schema(schema)).parquet(*folders)
    return rows.drop("version")


def _folder(version: Version) -> str:
    return f"{version.table}/ingest_id={version.ingest_id}/version={version.name}"


def _home(path: str, home: str | None) -> str:
    return (home or path).rstrip("/")


def _relative(table: str, home: str) -> str:
    if table != home and not table.startswith(home + "/"):
        raise ValueError(f"{table} is not below {home}")
    return table.removeprefix(home).strip("/")


def _names(spark: SparkSession, folder: str) -> list[str]:
    system, path = file_system(spark, folder)
    return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []


def _notes(spark: SparkSession, home: str) -> dict[str, list[tuple[int, str]]]:
    """For each run its notes in order, number and path."""
    found: dict[str, list[tuple[int, str]]] = {}
    for name in _names(spark, f"{home}/_published"):
        run, dot, number = name.rpartition(".")
        if dot and run and number.isdigit():
            found.setdefault(run, []).append((int(number), f"{home}/_published/{name}"))
    return {run: sorted(notes) for run, notes in found.items()}


def _content(spark: SparkSession, note: str) -> dict[str, str]:
    system, path = file_system(spark, note)
    stream = system.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def append_folder(rows: DataFrame, path: str, ingest_id: int | str) -> None:
    """Put the rows of one ingest run into its own partition.

    Repeating the run replaces its rows and touches no other's; if it fails, the rows
    it put there before stay.
    """
    replace_run(rows, path, ingest_id)


def replace_run(rows: DataFrame, path: str, ingest_id: int | str, *more_partitions: str) -> None:
    """Put these rows, or none, in place of all that a run has put into the table."""
    publish(rows.sparkSession, stage(rows, path, ingest_id, *more_partitions))


def write_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    connections: int = 16,
    batch_size: int = BATCH_SIZE,
) -> None:
    """Append to an external database over at most ``connections`` connections.

    A task commits its own rows; a repeated task repeats them, so the target
    needs a key or a staging table.
    """
    rows.write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize=batch_size, numPartitions=connections, **properties
    ).save()


def drop_table(spark: SparkSession, name: str) -> bool:
    """Drop whether or not the table has rows; False when there is none.

    The rows go as well, also those at a location, if ``create_table`` made the
    table. Of another external table only the entry goes, as Spark itself does it.
    """
    if not spark.catalog.tableExists(name):
        return False
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name IN ('Location', 'Type')")
    known = {r.col_name: r.data_type for r in about.collect()}
    owned = not spark.sql(f"SHOW TBLPROPERTIES {name}").filter(f"key = '{OWNED}' AND value = 'true'").isEmpty()
    spark.sql(f"DROP TABLE {name}")
    if owned and known.get("Type") == "EXTERNAL" and known.get("Location"):
        delete_folder(spark, known["Location"])
    return True


def drop_filled_table(spark: SparkSession, name: str) -> bool:
    """Drop only a table that exists and has a row; tells whether it did."""
    if not spark.catalog.tableExists(name) or spark.table(name).isEmpty():
        return False
    return drop_table(spark, name)
