import hashlib
import random

import pytest
from pyspark.sql import functions as F

from inkspan.operators import chunks, integrity, profile, routing
from inkspan.operators.embedding import (
    HashingEmbedder, choose_embedder, embed_chunks, embedding,
)

PAGES = "file_name string, page int, text string"
THREE_PAGES = [("f", 0, "a|b"), ("f", 1, "  "), ("f", 2, "c"), ("g", 0, "d")]


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_numbers_through_a_file(spark):
    pages = spark.createDataFrame(THREE_PAGES, PAGES)
    made = chunks.chunk_rows(pages, 1, 0, "|")
    assert rows(made, "file_name", "document_page", "chunk_no", "text") == [
        ("f", 0, 0, "a"), ("f", 0, 1, "b"), ("f", 2, 2, "c"), ("g", 0, 0, "d"),
    ]


def test_numbers_per_page(spark):
    pages = spark.createDataFrame(THREE_PAGES, PAGES)
    made = chunks.chunk_rows_compact(pages, 1, 0, "|")
    assert rows(made, "file_name", "page_num", "chunk_no") == [
        ("f", 0, 0), ("f", 0, 1), ("f", 2, 0), ("g", 0, 0),
    ]


def test_line_numbers_count_fallback_pages(spark):
    pages = spark.createDataFrame([("f", 0, "a\n b"), ("f", 1, "  "), ("f", 2, "c"), ("f", 3, "")], PAGES)
    made = chunks.line_rows(pages)
    assert rows(made, "page", "chunk_number", "text", "file_type") == [
        ("0", 0, "a", "pdf"), ("0", 1, "b", "pdf"), ("1", 2, "  ", "pdf"), ("2", 3, "c", "pdf"),
    ]


def test_numbering_in_blocks_equals_numbering_in_one(spark):
    pages = spark.range(300).select(
        F.when(F.col("id") < 280, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 5)).alias(
            "file_name"
        ),
        F.col("id").cast("int").alias("page"),
        F.repeat(F.lit("x|"), (F.col("id") * 7 % 5).cast("int")).alias("text"),
    )
    key = ("file_name", "document_page", "chunk_no", "text")
    whole = rows(chunks.chunk_rows(pages, 1, 0, "|"), *key)
    assert rows(chunks.chunk_rows(pages, 1, 0, "|", pages_per_block=13), *key) == whole
    hot = sorted(r[2] for r in whole if r[0] == "hot")
    assert hot == list(range(len(hot)))


def test_compact_view_and_key(spark):
    full = spark.createDataFrame(
        [("f", 1, 2, "t", [0.5])],
        "file_name string, document_page int, chunk_no int, text string, chunk_vector array<float>",
    )
    assert rows(chunks.compact_view(full), "page_num", "chunk_text", "vector") == [(1, "t", [0.5])]
    keyed = full.select(chunks.chunk_key("file_name", "document_page", "chunk_no").alias("k"))
    assert keyed.first() == keyed.first() and len(keyed.first().k) == 32


def test_hashing_embedder(spark):
    texts = ["b A a", "", "　"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    made = frame.select("i", embedding("text", lambda: HashingEmbedder(8)).alias("e")).select(
        "i", "e.*"
    ).orderBy("i").collect()
    expected = [0.0] * 8
    for token, n in (("a", 2), ("b", 1)):
        expected[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 8] += n / 5**0.5
    assert made[0].embedding == pytest.approx(expected)
    assert [(r.prompt_tokens, r.total_tokens, r.model) for r in made] == [
        (3, 3, "token-hash"), (0, 0, "token-hash"), (0, 0, "token-hash"),
    ]
    assert made[1].embedding == [0.0] * 8


class Flaky:
    """Fails the first call of every text, and a text with ``bad`` always."""

    model = "flaky"

    def __init__(self):
        self.seen = set()

    def embed(self, texts):
        if any("bad" in t for t in texts):
            raise ValueError("bad text")
        new = set(texts) - self.seen
        self.seen |= new
        if new:
            raise TimeoutError("first call")
        return [[1.0]] * len(texts), [1] * len(texts)


def test_embedder_failures_become_rows(spark):
    texts = ["one", "bad", "two", "  "]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    made = embed_chunks(frame, Flaky, request_size=3)
    assert rows(made, "text", "chunk_vector", "error", "model") == [
        ("bad", None, "ValueError: bad text", None),
        ("one", [1.0], None, "flaky"), ("two", [1.0], None, "flaky"),
    ]
    once = embed_chunks(frame, Flaky, request_size=3, attempts=1)
    assert rows(once.filter("error IS NOT NULL"), "text") == [("bad",), ("one",), ("two",)]


def test_provider_choice():
    factories = {"local": HashingEmbedder, "flaky": Flaky}
    assert choose_embedder("flaky", factories) is Flaky
    with pytest.raises(ValueError):
        choose_embedder("remote", factories)


def test_hash_verification(spark):
    files = spark.createDataFrame(
        [(k, b"content") for k in ("same", "other", "none", "null")], "key string, content binary"
    )
    manifest = spark.createDataFrame(
        [("same", hashlib.md5(b"content").hexdigest()), ("other", "0"), ("null", None)],
        "key string, file_hash string",
    )
    assert rows(integrity.verify_hashes(files, manifest), "key", "verified") == [
        ("none", True), ("null", True), ("other", False), ("same", True),
    ]


def test_duplicates_keep_the_lowest_id(spark):
    documents = spark.range(1000).select(
        (1000 - F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 50)).alias(
            "text"
        ),
    )
    kept = integrity.drop_duplicates(documents)
    expected = {}
    for r in documents.collect():
        expected[r.text] = min(expected.get(r.text, r.doc_id), r.doc_id)
    assert rows(kept, "text", "doc_id") == sorted(expected.items())
    assert integrity.duplicate_groups(documents).agg(F.sum("copies")).first()[0] == 1000


def test_ledger(spark):
    files = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1")], "key string, hash string")
    ledger = spark.createDataFrame([("a", "1"), ("a", "1")], "key string, hash string")
    assert rows(integrity.not_processed(files, ledger, "key", "hash"), "key", "hash") == [
        ("a", "2"), ("b", "1"),
    ]


def test_profile(spark):
    table = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, None)], "i int, embedding array<float>")
    assert tuple(profile.table_profile(table).first()) == (3, 2)
    assert rows(profile.column_listing(table), "position", "column_name", "data_type") == [
        (0, "i", "int"), (1, "embedding", "array<float>"),
    ]
    assert rows(profile.keep_dimension(table, 2), "i") == [(2,)]
    rejected = profile.rejected_dimension(table, 2).collect()
    assert sorted((r.n_dims is None, r.n_dims or 0, r.n_rows) for r in rejected) == [
        (False, 1, 1), (True, 0, 1),
    ]


def test_document_stats(spark):
    pages = spark.createDataFrame(THREE_PAGES + [("empty", 0, " ")], PAGES)
    stats = profile.document_stats(pages, 1, 0, "|")
    assert rows(stats, "file_name", "n_pages", "n_chunks") == [
        ("empty", 1, 0), ("f", 3, 3), ("g", 1, 1),
    ]
    made = chunks.chunk_rows(pages, 1, 0, "|")
    assert rows(profile.files_without_rows(pages.select("file_name").distinct(), made), "file_name") == [
        ("empty",)
    ]


def replay(events, limit=3):
    """Routes of (id, key, ts, failed) one delivery after the other."""
    open_failures, out = {}, {}
    for i, key, _, failed in sorted(events, key=lambda e: (e[2], e[0])):
        attempt = open_failures.get(key, 0) + 1
        to = "done" if not failed else "dead_letter" if attempt >= limit else "retry"
        open_failures[key] = attempt if to == "retry" else 0
        out[i] = (attempt, to)
    return out


def route(spark, events, **options):
    frame = spark.createDataFrame(events, "id long, key string, at long, failed boolean").withColumn(
        "ts", F.timestamp_seconds("at")
    )
    routed = routing.route_deliveries(frame, "key", "ts", "id", "failed", **options)
    return {r.id: (r.attempt, r.route) for r in routed.collect()}


def test_route_golden(spark):
    failing = [(i, "k", i, True) for i in range(3)]
    assert list(route(spark, failing).values()) == [(1, "retry"), (2, "retry"), (3, "dead_letter")]
    mixed = [(0, "k", 0, True), (1, "k", 1, False), (2, "k", 2, True)]
    assert list(route(spark, mixed).values()) == [(1, "retry"), (2, "done"), (1, "retry")]


@pytest.mark.parametrize("rows_per_block", [3, 10, 1000])
def test_routes_equal_replay_with_a_hot_key(spark, rows_per_block):
    rng = random.Random(5)
    events = [
        (i, "hot" if i % 3 else f"k{i % 7}", rng.randrange(40), rng.random() < 0.7)
        for i in range(400)
    ]
    assert route(spark, events, rows_per_block=rows_per_block) == replay(events)


def test_routes_of_one_instant(spark):
    events = [(i, "k", 5, i % 4 != 0) for i in range(50)]
    assert route(spark, events, rows_per_block=4) == replay(events)


def test_dead_letters_and_redrive(spark):
    routed = spark.createDataFrame(
        [("a", "dead_letter"), ("b", "dead_letter"), ("c", "retry")], "message_id string, route string"
    )
    letters = routing.dead_letters(routed)
    assert rows(letters, "message_id", "failure_reason") == [
        ("a", "Exceeded max retry attempts"), ("b", "Exceeded max retry attempts"),
    ]
    done = spark.createDataFrame([("a",)], "message_id string")
    assert rows(routing.redrive(letters, done), "message_id") == [("b",)]


def test_embedding_holds_one_request_of_texts():
    """Python objects of a task follow a request, not a batch of texts."""
    import tracemalloc

    import pyarrow as pa

    from inkspan.operators import embedding

    batch = pa.array([" ".join(f"{i}-{j}" for j in range(60)) for i in range(4000)])
    run = embedding._embedding_udf(embedding.HashingEmbedder, 256, 3).func
    tracemalloc.start()
    try:
        made = next(run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(made) == 4000 and made.field("error").null_count == 4000 and peak < 14 << 20
