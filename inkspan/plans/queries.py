"""The registered queries: every operator over the given tables.

Which table stands for which input is said in ``inputs`` below; each query
works on whole tables and whole texts.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from inkspan.functions import times, vectors
from inkspan.functions.messages import event_key, event_keys, notification_body
from inkspan.functions.splitting import page_chunk_array
from inkspan.functions.text import (
    basename, forward_slashes, has_suffix, is_blank, preview, stem, with_extension,
)
from inkspan.operators import chunks, integrity, ivf, lsh, pq, profile, routing, search
from inkspan.operators.ann import METHODS, VectorIndex
from inkspan.operators.embedding import HashingEmbedder, choose_embedder, embedding
from inkspan.plans.vectorize import (
    consume_notifications, export_csv, import_csv, read_chunks, read_outcomes, redrive, vectorize_files, vectorize_pages,
)
from inkspan.schemas import CHUNK, OUTCOME
from inkspan.session import shared_folder, spread
from inkspan.sources import exports, files, notifications, tables
from inkspan.streaming import ingest, routing as stream_routing, timed

DIM = 64
CHUNK_SIZE = 1000
OVERLAP = 200
TURN_CHUNK_SIZE = 400
K = 10
# Rows of one list of a trained index.
LIST_ROWS = 12
# Of the ten lists around the label means; eight hold nine of ten neighbours (README).
PROBES = 8
BUCKET = "documents-bucket"
AS_OF = "2024-01-01 00:00:00"
EVENT_CUTS = ("2024-01-11", "2024-01-21")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- inputs -----------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    """Files of one page; the extension depends on the language."""
    extension = (
        F.when(F.col("lang") == "en", ".pdf")
        .when(F.col("lang") == "fr", ".PDF")
        .when(F.col("lang") == "de", ".txt")
        .otherwise(".pdf.bak")
    )
    return table(spark, sf_dir, "documents").withColumn(
        "file_name", F.concat("source", F.lit("/doc_"), F.col("doc_id"), extension)
    ).withColumn("page", F.lit(0))


def documents_to_split(spark, sf_dir) -> DataFrame:
    return spread(documents(spark, sf_dir), "doc_id")


def turns(spark, sf_dir) -> DataFrame:
    """Conversations as files, their turns as pages."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("file_name"),
        F.col("turn").cast("int").alias("page"),
        "text",
    )


def embeddings(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def uneven_embeddings(spark, sf_dir) -> DataFrame:
    """Embeddings, those of label 3 short of one element."""
    short = F.slice("embedding", 1, DIM - 1)
    return embeddings(spark, sf_dir).withColumn(
        "embedding", F.when(F.col("label") == 3, short).otherwise(F.col("embedding"))
    )


def label_means(spark, sf_dir) -> DataFrame:
    """(label, mean): the mean vector of each label, from the whole table."""
    return (
        embeddings(spark, sf_dir)
        .select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos")
        .agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
        .groupBy("label")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("xs"))
        .select("label", F.transform("xs", lambda e: e.x).alias("mean"))
    )


def query_vectors(spark, sf_dir) -> DataFrame:
    return label_means(spark, sf_dir).select(
        F.col("label").alias("query_id"), F.col("mean").alias("query_vector")
    )


def stored_queries(spark, sf_dir) -> DataFrame:
    """Every row whose id is divisible by 50 asks for its neighbours."""
    return embeddings(spark, sf_dir).filter(F.col("vec_id") % 50 == 0).select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector")
    )


def dirty_embeddings(spark, sf_dir) -> DataFrame:
    """Embeddings with NaN (label 1), infinite (2), NULL (4) and small (6) vectors."""
    def first(x: float):
        rest = F.slice(F.col("embedding").cast("array<double>"), 2, DIM - 1)
        return F.concat(F.array(F.lit(x)), rest)

    small = F.transform("embedding", lambda x: x.cast("double") * F.lit(1e-6))
    return embeddings(spark, sf_dir).withColumn(
        "embedding",
        F.when(F.col("label") == 1, first(float("nan")))
        .when(F.col("label") == 2, first(float("inf")))
        .when(F.col("label") == 4, F.lit(None))
        .when(F.col("label") == 6, small)
        .otherwise(F.col("embedding").cast("array<double>")),
    )


def label_centroids(spark, sf_dir) -> DataFrame:
    return label_means(spark, sf_dir).select(
        F.col("label").alias("list_id"), F.col("mean").alias("centroid")
    )


def deliveries(spark, sf_dir) -> DataFrame:
    """Events as message deliveries to one file per user; an error is a failure."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id",
        times.utc_instant("ts").alias("ts"),
        (F.col("event_type") == "error").alias("failed"),
    )


def envelopes(spark, sf_dir) -> DataFrame:
    """Events as notifications of the files ``user_<id>.pdf``."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("message_id"),
        notification_body(BUCKET, F.concat(F.lit("user_"), F.col("user_id"), F.lit(".pdf"))).alias(
            "body"
        ),
        F.lit(1).alias("receive_count"),
        times.utc_instant("ts").alias("ts"),
    )


def manifest(docs: DataFrame) -> DataFrame:
    """Recorded hashes: wrong for French files, missing for German ones."""
    good = integrity.content_hash("text")
    return docs.select(
        F.col("file_name").alias("key"),
        F.when(F.col("lang") == "fr", F.reverse(good))
        .when(F.col("lang") != "de", good)
        .alias("file_hash"),
    )


def rounded_matches(found: DataFrame, *ids: str) -> DataFrame:
    return found.select(*ids, F.round("score", 6).alias("score"))


# --- splitting and chunk rows -----------------------------------------------


@query
def chunk_text(spark, sf_dir):
    return documents_to_split(spark, sf_dir).select(
        "doc_id",
        F.posexplode(page_chunk_array("text", CHUNK_SIZE, 0, "\n")).alias("chunk_no", "text"),
    )


@query
def chunk_overlap(spark, sf_dir):
    return documents_to_split(spark, sf_dir).select(
        "doc_id",
        F.posexplode(page_chunk_array("text", CHUNK_SIZE, OVERLAP, "\n")).alias(
            "chunk_no", "text"
        ),
    )


@query
def line_chunks(spark, sf_dir):
    return chunks.line_rows(documents_to_split(spark, sf_dir), one_page_files=True)


@query
def line_chunks_by_file(spark, sf_dir):
    return chunks.line_rows(turns(spark, sf_dir))


@query
def chunk_rows(spark, sf_dir):
    return chunks.chunk_rows(turns(spark, sf_dir), TURN_CHUNK_SIZE, 0, "\n")


@query
def chunk_rows_blocked(spark, sf_dir):
    """As ``chunk_rows``, with files spread over blocks of two pages."""
    return chunks.chunk_rows(turns(spark, sf_dir), TURN_CHUNK_SIZE, 0, "\n", pages_per_block=2)


@query
def chunk_rows_compact(spark, sf_dir):
    return chunks.chunk_rows_compact(turns(spark, sf_dir), TURN_CHUNK_SIZE, 0, "\n")


@query
def nonblank_filter(spark, sf_dir):
    return (
        documents(spark, sf_dir)
        .select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
        .filter(~is_blank("line"))
    )


# --- scans, pages, exports --------------------------------------------------


@query
def scan_suffix_filter(spark, sf_dir):
    return (
        documents(spark, sf_dir)
        .select(
            "file_name",
            has_suffix("file_name", ".pdf").alias("is_pdf"),
            has_suffix("file_name", ".pdf", ignore_case=True).alias("is_pdf_any_case"),
        )
        .filter("is_pdf OR is_pdf_any_case")
    )


def _odd_names(spark, sf_dir) -> DataFrame:
    """Documents under names with blanks, ``#``, ``%`` and other letters."""
    return documents(spark, sf_dir).withColumn(
        "key", F.concat(F.lit("文書 #"), F.translate("file_name", "/", "%"))
    )


def _document_files(spark, sf_dir, parts: int = 0) -> str:
    """The documents written as one file each."""
    folder = shared_folder(spark, "files")
    made = _odd_names(spark, sf_dir).select("key", F.encode("text", "UTF-8").alias("content"))
    files.write_files(made, folder, parts)
    return folder


def _parts(n_files: int) -> int:
    return -(-n_files // files.PART_FILES)


@query
def scan_folder(spark, sf_dir):
    """Files of the documents, found by their ending in one case and in any."""
    folder = _document_files(spark, sf_dir, _parts(documents(spark, sf_dir).count()))
    exact = files.read_folder(spark, folder, "pdf", content=False).select("path", F.lit(True).alias("exact"))
    found = files.read_folder(spark, folder, "pdf", ignore_case=True, content=False).select("path", "length")
    # Spark cannot tell how many files the tasks list.
    return found.join(exact.hint("merge"), "path", "left").select(
        F.regexp_extract("path", r"doc_(\d+)", 1).cast("long").alias("doc_id"), "length",
        F.coalesce("exact", F.lit(False)).alias("is_exact"),
    )


@query
def page_failures(spark, sf_dir):
    """Documents through a parser with two tries: some files fail once, some always."""
    tried = set()

    def parser(content: bytes) -> list[str]:
        if len(content) % 5 == 0:
            raise ValueError("a broken file")
        if len(content) % 5 == 1 and content not in tried:
            tried.add(content)
            raise OSError("once")
        return [content.decode("utf-8")]

    given = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("path"), F.encode("text", "UTF-8").alias("content")
    )
    made = files.extract_pages(given, parser, attempts=2)
    return made.select(
        F.col("path").cast("long").alias("doc_id"), F.coalesce("page", F.lit(-1)).alias("page"),
        F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"), "error",
    )


@query
def pages_of_files(spark, sf_dir):
    """Files of several pages, cut by a parser that has two tries for each."""
    folder = shared_folder(spark, "files")
    texts = exports.pages_as_text(turns(spark, sf_dir), "\f").groupBy("file_name").agg(
        F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("page", "text"))), lambda r: r.text
        ), "").alias("text")
    )
    files.write_files(texts.select(
        F.concat("file_name", F.lit(".txt")).alias("key"), F.encode("text", "UTF-8").alias("content")
    ), folder, _parts(turns(spark, sf_dir).select("file_name").distinct().count()))
    read = files.read_folder(spark, folder, "txt")
    made = files.extract_pages(read, files.parse_form_feed_text, attempts=2)
    return files.good_pages(made).select(basename("file_name").alias("file_name"), "page", "text")


@query
def column_listing(spark, sf_dir):
    return profile.column_listing(embeddings(spark, sf_dir)).select("position", "column_name")


@query
def chunk_keys(spark, sf_dir):
    """Surrogate keys of the chunk rows: as many as there are rows."""
    rows = chunks.chunk_rows(turns(spark, sf_dir), TURN_CHUNK_SIZE, 0, "\n")
    keyed = rows.withColumn("chunk_key", chunks.chunk_key("file_name", "chunk_no"))
    return keyed.agg(F.count("*").alias("n_rows"), F.countDistinct("chunk_key").alias("n_keys"))


@query
def provider_choice(spark, sf_dir):
    """Token counts by the embedder that a provider name chooses."""
    factory = choose_embedder("hashing", {"hashing": HashingEmbedder})
    made = documents_to_split(spark, sf_dir).select(
        "doc_id", embedding("text", factory).alias("made")
    )
    return made.select("doc_id", "made.total_tokens")


@query
def path_parts(spark, sf_dir):
    windows_path = F.translate("url", "/", "\\")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        basename("url").alias("base_name"),
        stem("url").alias("stem"),
        with_extension(basename("url"), ".csv").alias("csv_name"),
        forward_slashes(windows_path).alias("slashed"),
    )


@query
def html_text(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages"), "page_id")
    return pages.select("page_id", files.html_text("html").alias("text"))


def _html_files(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id").select(
        F.col("page_id").cast("string").alias("path"), F.encode("html", "UTF-8").alias("content")
    )


@query
def extract_pages(spark, sf_dir):
    made = files.extract_pages(_html_files(spark, sf_dir), files.parse_html)
    return made.select("path", "page", "text", F.col("error").isNull().alias("parsed"))


@query
def pages_json(spark, sf_dir):
    return exports.pages_as_json(files.with_source(turns(spark, sf_dir)))


@query
def doc_text_join(spark, sf_dir):
    return exports.pages_as_text(turns(spark, sf_dir))


@query
def csv_roundtrip(spark, sf_dir):
    path = shared_folder(spark, "csv")
    rows = embeddings(spark, sf_dir).select(
        F.col("vec_id").cast("string").alias("file_name"),
        F.col("label").alias("document_page"),
        F.lit(0).alias("chunk_no"), F.lit("").alias("text"), F.lit("given").alias("model"),
        F.lit(0).alias("prompt_tokens"), F.lit(0).alias("total_tokens"),
        times.utc_instant(F.lit(AS_OF)).alias("created_date_time"),
        F.col("embedding").alias("chunk_vector"),
    )
    export_csv(rows, path)
    return exports.read_chunks_csv(spark, path).select(
        F.col("file_name").cast("long").alias("vec_id"),
        F.col("document_page").alias("label"),
        "text",
        times.zoned_text("created_date_time").alias("created"),
        F.posexplode("chunk_vector").alias("pos", "value"),
    ).withColumn("value", F.col("value").cast("double"))


@query
def csv_text_roundtrip(spark, sf_dir):
    path = shared_folder(spark, "csv")
    exports.write_csv(documents(spark, sf_dir).select("doc_id", "text"), path, quote_all=False)
    schema = table(spark, sf_dir, "documents").select("doc_id", "text").schema
    return exports.read_csv(spark, path, schema).filter(
        F.col(exports.CORRUPT).isNull()
    ).select("doc_id", "text")


@query
def csv_two_step(spark, sf_dir):
    """Chunk and embed to CSV, then CSV to the chunk table."""
    csv, out = shared_folder(spark, "csv"), shared_folder(spark, "chunks")
    made = vectorize_pages(turns(spark, sf_dir), size=TURN_CHUNK_SIZE, separator="\n")
    export_csv(made.filter("error IS NULL"), csv)
    import_csv(spark, csv, DIM, out, ingest_id=0)
    return ingest.read_table(spark, out, CHUNK).select(
        "file_name", "document_page", "chunk_no", "text", "model", "prompt_tokens",
        F.size("chunk_vector").alias("n_dims"),
    )


@query
def append_chunks(spark, sf_dir):
    """Two ingest runs over one table, the first of them repeated."""
    path = shared_folder(spark, "chunks")
    rows = embeddings(spark, sf_dir)
    low = F.coalesce(F.col("label") < 5, F.lit(False))
    for run, part in ((0, low), (1, ~low), (0, low)):
        tables.append_folder(rows.filter(part), path, run)
    return tables.read_runs(spark, path).select(
        "vec_id", "label", F.col("ingest_id").cast("int").alias("ingest_id"),
        F.size("embedding").alias("n_dims"),
    )


@query
def append_empty_rerun(spark, sf_dir):
    """Two ingest runs; the first is repeated and finds nothing."""
    path = shared_folder(spark, "chunks")
    rows = embeddings(spark, sf_dir).select("vec_id", "label")
    low = F.coalesce(F.col("label") < 5, F.lit(False))
    for run, part in ((0, low), (1, ~low), (0, F.lit(False))):
        tables.append_folder(rows.filter(part), path, run)
    return tables.read_runs(spark, path).select("vec_id", F.col("ingest_id").cast("int").alias("ingest_id"))


@query
def failed_rerun(spark, sf_dir):
    """Two ingest runs; the first is repeated, and its job fails on one row."""
    path = shared_folder(spark, "chunks")
    rows = embeddings(spark, sf_dir).select("vec_id", "label")
    low = F.coalesce(F.col("label") < 5, F.lit(False))
    for run, part in ((0, low), (1, ~low)):
        tables.append_folder(rows.filter(part), path, run)
    last = rows.agg(F.max("vec_id")).first()[0]
    broken = F.when(F.col("vec_id") == last, F.raise_error(F.lit("a broken row"))).otherwise(F.col("label"))
    try:
        tables.append_folder(rows.withColumn("label", broken.cast("int")), path, 0)
    except PySparkException as failure:
        if "a broken row" not in str(failure):
            raise
    return tables.read_runs(spark, path).select("vec_id", "label", F.col("ingest_id").cast("int").alias("ingest_id"))


@query
def ingest_counts(spark, sf_dir):
    """Files and rows of three ingest runs of one chunk table."""
    path = shared_folder(spark, "chunks")
    rows = embeddings(spark, sf_dir).withColumn(
        "file_name", F.concat(F.lit("label_"), F.col("label"), F.lit(".pdf"))
    )
    run_of = F.when(F.col("label") < 3, 0).when(F.col("label") < 7, 1).otherwise(2)
    for run in range(3):
        tables.append_folder(rows.filter(run_of == run), path, run)
    return profile.ingest_counts(tables.read_runs(spark, path))


@query
def table_lifecycle(spark, sf_dir):
    location = shared_folder(spark, "table")
    name = "inkspan_" + location[-12:]
    rows = embeddings(spark, sf_dir)
    tables.create_table(spark, name, rows.schema, location)
    tables.create_table(spark, name, rows.schema, location)
    kept_empty = not tables.drop_filled_table(spark, name)
    tables.append_table(rows, name)
    n_rows = spark.table(name).count()
    dropped = tables.drop_filled_table(spark, name)
    missing = not tables.drop_table(spark, name)
    tables.create_table(spark, name, rows.schema, location)
    n_rows_again = spark.table(name).count()
    tables.drop_table(spark, name)
    return spark.createDataFrame(
        [(kept_empty, n_rows, dropped, missing, n_rows_again)],
        "kept_empty boolean, n_rows bigint, dropped_filled boolean, then_missing boolean,"
        " n_rows_again bigint",
    )


@query
def vectorize_html(spark, sf_dir):
    """Raw files to the chunk table: parse, split, embed, write, read back."""
    out = shared_folder(spark, "chunks")
    vectorize_files(
        _html_files(spark, sf_dir), files.parse_html, out, 0, size=CHUNK_SIZE, separator=". "
    )
    return ingest.read_table(spark, out, CHUNK).select(
        "file_name", "document_page", "chunk_no", "text", "model", "total_tokens",
        F.size("chunk_vector").alias("n_dims"),
    )


@query
def vector_table(spark, sf_dir):
    made = vectorize_pages(turns(spark, sf_dir), size=TURN_CHUNK_SIZE, separator="\n")
    return made.withColumn("created_date_time", times.utc_instant(F.lit(AS_OF))).select(
        "file_name", "document_page", "chunk_no", "text", "model",
        "prompt_tokens", "total_tokens",
        times.zoned_text("created_date_time").alias("created"),
        vectors.is_normalized("chunk_vector").alias("is_normalized"),
    )


# --- table inspection -------------------------------------------------------


@query
def scan_vectors(spark, sf_dir):
    return embeddings(spark, sf_dir).select(
        "vec_id", "label", vectors.dimensions("embedding").alias("n_dims"),
        F.round(vectors.inner_product("embedding", "embedding"), 6).alias("square_sum"),
    )


@query
def sample_row(spark, sf_dir):
    return profile.sample_rows(embeddings(spark, sf_dir), "vec_id", 1).select("vec_id", "label")


@query
def table_profile(spark, sf_dir):
    return profile.table_profile(embeddings(spark, sf_dir))


@query
def doc_stats(spark, sf_dir):
    return profile.document_stats(turns(spark, sf_dir), TURN_CHUNK_SIZE, 0, "\n")


@query
def empty_docs(spark, sf_dir):
    """Spanish files hold blanks only and give no chunk."""
    docs = documents(spark, sf_dir).withColumn(
        "text", F.when(F.col("lang") == "es", F.lit(" \n　 ")).otherwise(F.col("text"))
    )
    rows = docs.select("file_name", F.explode(page_chunk_array("text", CHUNK_SIZE, 0, "\n")))
    return profile.files_without_rows(docs.select("file_name"), rows)


@query
def dim_filter(spark, sf_dir):
    return profile.keep_dimension(uneven_embeddings(spark, sf_dir), DIM).select("vec_id")


@query
def dim_rejects(spark, sf_dir):
    return profile.rejected_dimension(uneven_embeddings(spark, sf_dir), DIM)


@query
def dim_histogram(spark, sf_dir):
    return profile.dimension_histogram(uneven_embeddings(spark, sf_dir))


# --- vectors ----------------------------------------------------------------


@query
def vector_parse(spark, sf_dir):
    text = vectors.format_vector("embedding")
    return embeddings(spark, sf_dir).select(
        "vec_id", F.posexplode(vectors.parse_vector(text)).alias("pos", "value")
    ).withColumn("value", F.col("value").cast("double"))


@query
def vector_preview(spark, sf_dir):
    shown = profile.vector_preview("embedding", 2)
    return embeddings(spark, sf_dir).select(
        "vec_id",
        F.get(shown.head, 0).cast("double").alias("first"),
        F.get(shown.head, 1).cast("double").alias("second"),
        F.size(shown.head).alias("n_shown"),
        F.length(shown.text).alias("n_characters"),
    )


@query
def text_preview(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", preview("text", 100).alias("shown"))


@query
def vector_norm(spark, sf_dir):
    return embeddings(spark, sf_dir).select(
        "vec_id",
        F.round(vectors.norm("embedding"), 6).alias("norm"),
        vectors.is_normalized("embedding").alias("is_normalized"),
    )


@query
def pair_distance(spark, sf_dir):
    left = embeddings(spark, sf_dir).select("vec_id", F.col("embedding").alias("a"))
    right = embeddings(spark, sf_dir).select(
        (F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b")
    )
    return left.join(right, "vec_id").select(
        "vec_id",
        F.round(vectors.negative_inner_product("a", "b"), 6).alias("negative_inner_product"),
        F.round(vectors.cosine_distance("a", "b"), 6).alias("cosine_distance"),
    )


@query
def half_quantize(spark, sf_dir):
    return embeddings(spark, sf_dir).select(
        "vec_id", F.posexplode(vectors.to_half("embedding")).alias("pos", "half")
    )


@query
def precision_audit(spark, sf_dir):
    return embeddings(spark, sf_dir).select(
        "vec_id", F.round(vectors.half_error(vectors.to_float32("embedding")), 9).alias("max_error")
    )


@query
def float_bits(spark, sf_dir):
    first = F.get("embedding", 0)
    return embeddings(spark, sf_dir).select(
        "vec_id",
        vectors.float_bits(first).alias("float32_hex"),
        vectors.half_bits(first).alias("float16_hex"),
    )


# --- search -----------------------------------------------------------------


@query
def knn_single(spark, sf_dir):
    rows = embeddings(spark, sf_dir)
    asked = rows.orderBy("vec_id").select("embedding").first()[0]
    return search.nearest(rows, asked, K).select("vec_id", F.round("score", 6).alias("score"))


@query
def knn_inner_product(spark, sf_dir):
    found = search.top_k(embeddings(spark, sf_dir), query_vectors(spark, sf_dir), K)
    return rounded_matches(found, "query_id", "rank", "vec_id")


@query
def knn_cosine(spark, sf_dir):
    found = search.top_k(
        embeddings(spark, sf_dir), query_vectors(spark, sf_dir), K, metric="cosine"
    )
    return found.select("query_id", "rank", "vec_id", F.round("distance", 6).alias("distance"))


@query
def knn_half(spark, sf_dir):
    """Inner product of vectors rounded to half precision, on both sides."""
    stored = embeddings(spark, sf_dir).withColumn("embedding", vectors.to_half("embedding"))
    asked = query_vectors(spark, sf_dir).withColumn(
        "query_vector", vectors.to_half("query_vector")
    )
    return rounded_matches(search.top_k(stored, asked, K), "query_id", "rank", "vec_id")


def _document_vectors(spark, sf_dir) -> DataFrame:
    """(chunk, embedding) of all document chunks."""
    return chunk_text(spark, sf_dir).select(
        F.concat_ws("/", "doc_id", "chunk_no").alias("chunk"),
        embedding("text").embedding.alias("embedding"),
    )


@query
def retrieve_chunks(spark, sf_dir):
    """The five best document chunks for each benchmark text."""
    asked = table(spark, sf_dir, "benchmark").select(
        "item_id", embedding("text").embedding.alias("query_vector")
    )
    found = search.top_k(
        _document_vectors(spark, sf_dir), asked, 5, id_col="chunk", query_id_col="item_id"
    )
    return rounded_matches(found, "item_id", "rank", "chunk")


@query
def ivf_assign(spark, sf_dir):
    return ivf.assign_lists(
        embeddings(spark, sf_dir), label_centroids(spark, sf_dir)
    ).select("vec_id", "list_id")


def _ivf_matches(spark, rows, centroids, asked) -> DataFrame:
    path = shared_folder(spark, "ivf")
    ivf.write_index(ivf.assign_lists(rows, centroids), path)
    return ivf.ivf_search(ivf.read_index(spark, path), centroids, asked, K, PROBES)


@query
def ivf_search(spark, sf_dir):
    found = _ivf_matches(
        spark, embeddings(spark, sf_dir), label_centroids(spark, sf_dir), query_vectors(spark, sf_dir)
    )
    return rounded_matches(found, "query_id", "rank", "vec_id")


@query
def ivf_recall(spark, sf_dir):
    rows, asked = embeddings(spark, sf_dir), stored_queries(spark, sf_dir)
    found = _ivf_matches(spark, rows, label_centroids(spark, sf_dir), asked)
    return search.recall(found, search.top_k(rows, asked, K), "query_id", "vec_id")


def _nine(found: DataFrame) -> DataFrame:
    return found.select("query_id", "rank", "vec_id", F.round("score", 9).alias("score"))


@query
def knn_dirty(spark, sf_dir):
    return _nine(search.top_k(dirty_embeddings(spark, sf_dir), stored_queries(spark, sf_dir), K))


@query
def ivf_dirty(spark, sf_dir):
    return _nine(_ivf_matches(
        spark, dirty_embeddings(spark, sf_dir), label_centroids(spark, sf_dir),
        stored_queries(spark, sf_dir),
    ))


@query
def lsh_dirty(spark, sf_dir):
    coded = lsh.add_codes(dirty_embeddings(spark, sf_dir), DIM)
    return _nine(lsh.lsh_search(coded, stored_queries(spark, sf_dir), K))


@query
def ivf_kmeans(spark, sf_dir):
    """An index with trained centroids: lists, rows, and rows that are not in the nearest list."""
    rows = embeddings(spark, sf_dir)
    centroids = ivf.train_centroids(rows)
    path = shared_folder(spark, "ivf")
    ivf.write_index(ivf.assign_lists(rows, centroids), path)
    index = ivf.read_index(spark, path)
    # At most MAX_LISTS centroids; each row is compared with them in the JVM.
    known = F.array(*(
        F.struct(F.lit(r.list_id).alias("list_id"), F.array(*map(F.lit, r.centroid)).alias("centroid"))
        for r in centroids.collect()
    ))
    products = F.transform(known, lambda c: F.struct(
        vectors.inner_product(F.col("embedding"), c["centroid"]).alias("score"), (-c["list_id"]).alias("order")
    ))
    own = F.element_at(F.filter(products, lambda p: p["order"] == -F.col("list_id")), 1)["score"]
    misplaced = F.array_max(products)["score"] > own + 1e-12
    return index.agg(
        F.lit(centroids.count()).cast("long").alias("n_lists"), F.count("*").alias("n_rows"),
        F.coalesce(F.sum(misplaced.cast("long")), F.lit(0)).alias("n_misplaced"),
    )


@query
def ivf_full_probe(spark, sf_dir):
    """Trained centroids, all lists probed: the exact result."""
    rows = embeddings(spark, sf_dir)
    centroids = ivf.train_centroids(rows)
    found = ivf.ivf_search(
        ivf.assign_lists(rows, centroids), centroids, query_vectors(spark, sf_dir), K, ivf.LISTS
    )
    return rounded_matches(found, "query_id", "rank", "vec_id")


def _bucket_index(spark, rows) -> DataFrame:
    path = shared_folder(spark, "lsh")
    lsh.write_buckets(lsh.add_codes(rows, DIM), path)
    return lsh.read_buckets(spark, path)


@query
def lsh_search(spark, sf_dir):
    coded = lsh.add_codes(embeddings(spark, sf_dir), DIM)
    found = lsh.lsh_search(coded, query_vectors(spark, sf_dir), K)
    return rounded_matches(found, "query_id", "rank", "vec_id")


@query
def lsh_recall(spark, sf_dir):
    rows, asked = embeddings(spark, sf_dir), stored_queries(spark, sf_dir)
    found = lsh.lsh_search(_bucket_index(spark, rows), asked, K)
    return search.recall(found, search.top_k(rows, asked, K), "query_id", "vec_id")


@query
def knn_join(spark, sf_dir):
    """The nearest rows of every row whose id 50 divides and of every benchmark text, in one job."""
    rows = embeddings(spark, sf_dir)
    stored = stored_queries(spark, sf_dir).select(
        F.concat(F.lit("v"), "query_id").alias("query_id"), F.col("query_vector").cast("array<double>").alias("query_vector")
    )
    asked = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("b"), "item_id").alias("query_id"),
        embedding("text").embedding.cast("array<double>").alias("query_vector"),
    )
    return rounded_matches(search.knn_join(rows, stored.unionByName(asked), K), "query_id", "rank", "vec_id")


@query
def knn_bounded(spark, sf_dir):
    """``knn_inner_product`` over lists, without those that cannot hold a match."""
    centroids, path = label_centroids(spark, sf_dir), shared_folder(spark, "ivf")
    ivf.write_index(ivf.assign_lists(embeddings(spark, sf_dir), centroids), path)
    index = ivf.read_index(spark, path)
    radii = ivf.list_radii(index, centroids)
    found = ivf.bounded_search(index, centroids, radii, query_vectors(spark, sf_dir), K, first=2)
    return found.select("query_id", "rank", "vec_id", F.round("score", 6).alias("score"), "lists_read")


@query
def pq_recall(spark, sf_dir):
    """How many neighbours of each stored query a search of the coded rows finds."""
    rows, asked = embeddings(spark, sf_dir), stored_queries(spark, sf_dir)
    book = pq.train_book(rows, DIM)
    path = shared_folder(spark, "pq")
    pq.add_codes(rows, book).select("vec_id", "code").write.parquet(path)
    found = pq.pq_search(spark.read.parquet(path), rows, book, asked, K)
    return search.recall(found, search.top_k(rows, asked, K), "query_id", "vec_id")


@query
def index_choice(spark, sf_dir):
    """Each index method, calibrated: how many neighbours of each stored query it finds."""
    rows, asked = embeddings(spark, sf_dir), stored_queries(spark, sf_dir)
    exact = VectorIndex(rows, "exact", DIM).search(asked, K)
    lists = max(1, rows.count() // LIST_ROWS)
    found = [
        search.recall(VectorIndex(rows, method, DIM, lists=lists).search(asked, K), exact, "query_id", "vec_id")
        .select(F.lit(method).alias("method"), "query_id", "found", "wanted", "recall")
        for method in METHODS
    ]
    return functools.reduce(DataFrame.unionByName, found)


# --- embedding --------------------------------------------------------------


@query
def hash_embed(spark, sf_dir):
    return (
        documents_to_split(spark, sf_dir)
        .select("doc_id", F.posexplode(embedding("text").embedding).alias("bucket", "weight"))
        .filter(F.col("weight") > 0)
        .withColumn("weight", F.round(F.col("weight").cast("double"), 6))
    )


@query
def token_usage(spark, sf_dir):
    made = documents_to_split(spark, sf_dir).select("doc_id", embedding("text").alias("made"))
    return made.select("doc_id", "made.model", "made.prompt_tokens", "made.total_tokens")


# --- integrity --------------------------------------------------------------


@query
def content_hash(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", integrity.content_hash("text").alias("content_hash")
    )


@query
def dedup_content(spark, sf_dir):
    return integrity.duplicate_groups(documents(spark, sf_dir))


@query
def dedup_rows(spark, sf_dir):
    return integrity.drop_duplicates(documents(spark, sf_dir)).select("doc_id", "lang", "text")


@query
def hash_verify(spark, sf_dir):
    docs = documents(spark, sf_dir)
    read = docs.select(F.col("file_name").alias("key"), F.col("text").alias("content"))
    return integrity.verify_hashes(read, manifest(docs)).fillna("none", "file_hash")


@query
def ledger_anti(spark, sf_dir):
    return integrity.not_processed(
        documents(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id"
    ).select("doc_id", "file_name")


# --- messages and times -----------------------------------------------------


@query
def notify_build(spark, sf_dir):
    """English files keep their name as object key, others have a key of their own."""
    listing = documents(spark, sf_dir).withColumn(
        "object_name",
        F.when(F.col("lang") != "en", F.concat(F.lit("in/"), basename("file_name"))),
    )
    return notifications.notifications(listing, BUCKET)


@query
def event_key_first(spark, sf_dir):
    """Bodies with two records: the user's file and the event's own."""
    user = F.concat(F.lit("user_"), F.col("user_id"), F.lit(".pdf"))
    event = F.concat(F.lit("event_"), F.col("event_id"), F.lit(".pdf"))
    body = F.concat(
        F.lit('{"Records":['),
        F.substring_index(F.substring_index(notification_body(BUCKET, user), "[", -1), "]", 1),
        F.lit(","),
        F.substring_index(F.substring_index(notification_body(BUCKET, event), "[", -1), "]", 1),
        F.lit("]}"),
    )
    bodies = table(spark, sf_dir, "events").select("event_id", body.alias("body"))
    return bodies.select(
        "event_id", event_key("body").alias("key"), F.size(event_keys("body")).alias("n_keys")
    )


QUERIES["event_key"] = QUERIES.pop("event_key_first")


@query
def jst_format(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", times.utc_instant("ts").alias("ts"))
    return events.select(
        "event_id",
        times.zoned_text("ts").alias("jst"),
        times.zoned_text("ts", "UTC", "UTC").alias("utc"),
        F.hour(times.wall_time("ts")).alias("jst_hour"),
    )


@query
def unix_roundtrip(spark, sf_dir):
    seconds = times.unix_seconds(times.utc_instant("ts"))
    events = table(spark, sf_dir, "events").select("event_id", seconds.alias("seconds"))
    return events.select(
        "event_id", "seconds",
        times.unix_text("seconds").alias("shown"),
        times.parse_unix(times.unix_text("seconds")).alias("seconds_again"),
    )


# --- routing and streams ----------------------------------------------------


def _routed(spark, sf_dir, rows_per_block=routing.ROWS_PER_BLOCK) -> DataFrame:
    return routing.route_deliveries(
        deliveries(spark, sf_dir), "user_id", "ts", "event_id", "failed",
        rows_per_block=rows_per_block,
    )


@query
def retry_route(spark, sf_dir):
    return _routed(spark, sf_dir).select("event_id", "user_id", "attempt", "route")


@query
def retry_route_blocked(spark, sf_dir):
    """As ``retry_route``, with the log cut into blocks of 2000 deliveries."""
    return _routed(spark, sf_dir, 2_000).select("event_id", "user_id", "attempt", "route")


@query
def dead_letters(spark, sf_dir):
    return routing.dead_letters(_routed(spark, sf_dir)).select(
        "event_id", "user_id", "failure_reason"
    )


def _named_letters(spark, sf_dir) -> DataFrame:
    """Dead letters; each names the document of the user's number."""
    return routing.dead_letters(_routed(spark, sf_dir)).select(
        "event_id", F.col("user_id").alias("doc_id")
    )


def _second_pass(letters: DataFrame, docs: DataFrame) -> DataFrame:
    """Ids of the letters whose document is there and has the recorded hash."""
    named = docs.withColumnRenamed("file_name", "key")
    wanted = named.join(letters.select("doc_id").distinct(), "doc_id", "left_semi")
    checked = integrity.verify_hashes(
        wanted.select("key", F.col("text").alias("content")), manifest(docs)
    )
    good = named.select("doc_id", "key").join(checked.filter("verified"), "key", "left_semi")
    return letters.join(good, "doc_id", "left_semi").select("event_id")


@query
def dlq_redrive(spark, sf_dir):
    """French documents fail again and stay dead letters."""
    letters = _named_letters(spark, sf_dir)
    succeeded = _second_pass(letters, documents(spark, sf_dir))
    return routing.redrive(letters, succeeded, "event_id")


@query
def dlq_redrive_stream(spark, sf_dir):
    """The same as a stream over the dead-letter table, with the outcome of each letter."""
    letters, out = shared_folder(spark, "letters"), shared_folder(spark, "redriven")
    found = _named_letters(spark, sf_dir)
    found.write.parquet(letters)
    docs = documents(spark, sf_dir)
    stream_routing.redrive_stream(
        spark, letters, found.schema, lambda batch: _second_pass(batch, docs),
        out, shared_folder(spark, "offsets"), message_id="event_id",
    )
    filed = T.StructType(found.schema.fields + [T.StructField("outcome", T.StringType())])
    return ingest.read_table(spark, out, filed).drop("ingest_id")


def _replay(spark, rows: DataFrame) -> str:
    path = shared_folder(spark, "queue")
    notifications.write_messages(rows, path)
    return path


@query
def queue_stream(spark, sf_dir):
    """Messages from files, consumed as a stream into a table."""
    queue = _replay(spark, envelopes(spark, sf_dir))
    out = shared_folder(spark, "messages")
    keyed = notifications.read_messages(spark, queue).select(
        "message_id", event_key("body").alias("key"), "receive_count"
    )
    ingest.run(
        keyed, lambda batch, batch_id: ingest.put(batch, batch_id, out),
        shared_folder(spark, "offsets"),
    )
    return ingest.read_table(spark, out, keyed.schema).drop("ingest_id")


@query
def dedup_stream(spark, sf_dir):
    """Every message delivered twice, kept once."""
    once = envelopes(spark, sf_dir)
    queue = _replay(spark, once.unionByName(once.withColumn("receive_count", F.lit(2))))
    out = shared_folder(spark, "messages")
    stream = ingest.unique_messages(notifications.read_messages(spark, queue)).select(
        "message_id", event_key("body").alias("key")
    )
    ingest.run(
        stream, lambda batch, batch_id: ingest.put(batch, batch_id, out),
        shared_folder(spark, "offsets"),
    )
    return ingest.read_table(spark, out, stream.schema).drop("ingest_id")


@query
def idempotent_ingest(spark, sf_dir):
    """All messages delivered in two runs; each message is in the table once."""
    queue, out = _replay(spark, envelopes(spark, sf_dir)), shared_folder(spark, "messages")
    offsets = shared_folder(spark, "offsets")

    def consume() -> DataFrame:
        stream = notifications.read_messages(spark, queue).select(
            "message_id", event_key("body").alias("key")
        )
        ingest.run(
            stream,
            lambda batch, batch_id: ingest.ingest(batch, batch_id, out, ("message_id",)),
            offsets,
        )
        return ingest.read_table(spark, out, stream.schema).drop("ingest_id")

    consume()
    notifications.write_messages(envelopes(spark, sf_dir), queue)
    return consume()


@query
def retry_timed(spark, sf_dir):
    """Events as messages of one file per user; errors fail once to three times, 30 s apart."""
    body = F.when(F.col("event_type") == "error", F.col("event_id") % 3 + 1).otherwise(0).cast("string")
    rows = table(spark, sf_dir, "events").select(
        "user_id", F.col("event_id").cast("string").alias("message_id"), times.utc_instant("ts").alias("ts"),
        body.alias("body"),
    )
    queue, out, offsets = (shared_folder(spark, p) for p in ("queue", "deliveries", "offsets"))
    rows.write.json(queue)

    def consume() -> DataFrame:
        stream = spark.readStream.schema(rows.schema).json(queue)
        tried = timed.timed_retries(stream, lambda body, attempt: attempt > int(body), "user_id")
        ingest.run(tried, lambda batch, batch_id: ingest.put(batch, batch_id, out), offsets)
        return ingest.read_table(spark, out, tried.schema).drop("ingest_id")

    with timed.rocksdb(spark):
        consume()
        # A message an hour later moves the time on, so that nothing waits any more.
        rows.agg(
            F.lit(None).cast(rows.schema["user_id"].dataType).alias("user_id"), F.lit("last").alias("message_id"),
            (F.max("ts") + F.expr("INTERVAL 1 HOUR")).alias("ts"), F.lit("0").alias("body"),
        ).write.mode("append").json(queue)
        found = consume()
    return found.filter("message_id <> 'last'").select(
        "user_id", F.col("message_id").cast("long").alias("event_id"), "attempt",
        F.unix_millis("at").alias("at_ms"), "route",
    )


@query
def retry_stream(spark, sf_dir):
    """Deliveries in three runs of one stream; open failures pass from run to run."""
    rows = deliveries(spark, sf_dir)
    queue, out = shared_folder(spark, "queue"), shared_folder(spark, "routes")
    offsets = shared_folder(spark, "offsets")
    first, second = (times.utc_instant(F.lit(c)) for c in EVENT_CUTS)
    run_of = F.when(F.col("ts") < first, 0).when(F.col("ts") < second, 1).otherwise(2)
    for number in range(3):
        rows.filter(run_of == number).write.mode("append").json(queue)
        stream = spark.readStream.schema(rows.schema).json(queue)
        stream_routing.route_stream(
            stream, "user_id", "ts", "event_id", "failed", out, offsets
        )
    return stream_routing.read_routes(spark, out).select(
        "event_id", "user_id", "attempt", "route"
    )


def _event_job(spark, sf_dir):
    """The event job over the files of the documents until no message waits."""
    # One folder of all files slows down those who write to it together.
    parts = _parts(documents(spark, sf_dir).count())
    folder = _document_files(spark, sf_dir, parts)
    queue, state = shared_folder(spark, "queue"), shared_folder(spark, "job")
    docs = _odd_names(spark, sf_dir)
    sent = docs.filter(has_suffix("key", ".pdf", ignore_case=True))
    notifications.write_messages(sent.select(
        F.col("doc_id").cast("string").alias("message_id"),
        notification_body(BUCKET, "key").alias("body"),
        F.lit(1).alias("receive_count"), times.utc_instant(F.lit(AS_OF)).alias("ts"),
    ), queue)

    def consume(hashes: DataFrame, runs: int) -> None:
        for _ in range(runs):
            consume_notifications(
                spark, queue, folder, hashes, files.parse_form_feed_text, state,
                f"{state}/offsets", parts=parts, size=CHUNK_SIZE, separator="\n",
            )

    consume(manifest(docs.drop("file_name").withColumnRenamed("key", "file_name")), routing.MAX_ATTEMPTS)
    return queue, state, consume, docs


def _last_outcomes(spark, state: str) -> DataFrame:
    outcomes = read_outcomes(spark, state)
    last = outcomes.groupBy("message_id").agg(
        F.max_by(F.struct("receive_count", "route", "error"), "ingest_id").alias("last")
    )
    return last.select(F.col("message_id").cast("long").alias("doc_id"), "last.*")


@query
def notify_to_table(spark, sf_dir):
    """Notified files to the chunk table; French ones have a wrong hash and die after three tries."""
    _, state, _, _ = _event_job(spark, sf_dir)
    made = read_chunks(spark, state).groupBy("file_name").agg(
        F.count("*").alias("n_chunks")
    ).select(F.regexp_extract("file_name", r"doc_(\d+)", 1).cast("long").alias("doc_id"), "n_chunks")
    found = _last_outcomes(spark, state).join(made, "doc_id", "left")
    return found.select(
        "doc_id", "receive_count", "route", F.coalesce("n_chunks", F.lit(0)).alias("n_chunks")
    )


@query
def redrive_job(spark, sf_dir):
    """The same, then the dead letters once more with the right hashes."""
    queue, state, consume, docs = _event_job(spark, sf_dir)
    redrive(spark, queue, state, 1)
    consume(docs.select("key", integrity.content_hash("text").alias("file_hash")), 1)
    return _last_outcomes(spark, state).select("doc_id", "receive_count", "route")
