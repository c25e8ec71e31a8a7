import pathlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkspan.operators import ivf, lsh, pq, search
from inkspan.operators.ann import VectorIndex
from inkspan.plans import queries as queries_of_plans

DIM = 8
VECTORS = "vec_id long, embedding array<float>"
QUERIES = "query_id int, query_vector array<float>"


def data(n=300, hot=100, queries=7, seed=3):
    """Vectors of which ``hot`` are one and the same, a zero vector, and queries."""
    rng = np.random.default_rng(seed)
    matrix = rng.normal(size=(n, DIM)).astype(np.float32)
    matrix[:hot] = matrix[0]
    matrix[-1] = 0
    ids = rng.permutation(n)
    asked = np.vstack([matrix[0], rng.normal(size=(queries - 1, DIM))]).astype(np.float32)
    return ids, matrix, asked


def frames(spark, ids, matrix, asked, parts=5):
    vectors = spark.createDataFrame(
        [(int(i), [float(x) for x in v]) for i, v in zip(ids, matrix)], VECTORS
    ).repartition(parts)
    queries = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(asked)], QUERIES
    )
    return vectors, queries


def brute(ids, matrix, asked, k, cosine=False, allowed=None):
    matrix, asked = matrix.astype(np.float64), asked.astype(np.float64)
    if cosine:
        asked = asked / np.linalg.norm(asked, axis=1, keepdims=True)
    out = {}
    for q, query in enumerate(asked):
        scored = []
        for i, v in zip(ids, matrix):
            length = np.linalg.norm(v)
            if (cosine and length == 0) or (allowed is not None and not allowed(q, int(i))):
                continue
            score = float(v @ query) / (length if cosine else 1.0)
            scored.append((-round(score, 9), int(i)))
        out[q] = [i for _, i in sorted(scored)[:k]]
    return out


def ranked(found, id_col="vec_id"):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r[id_col])
    return out


@pytest.mark.parametrize("k", [1, 5, 150, 1000])
def test_exact_search_with_many_copies(spark, k):
    ids, matrix, asked = data()
    vectors, queries = frames(spark, ids, matrix, asked)
    assert ranked(search.top_k(vectors, queries, k)) == brute(ids, matrix, asked, k)


def test_small_batches_give_the_same(spark):
    ids, matrix, asked = data()
    vectors, queries = frames(spark, ids, matrix, asked)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        assert ranked(search.top_k(vectors, queries, 9)) == brute(ids, matrix, asked, 9)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_cosine_leaves_zero_vectors_out(spark):
    ids, matrix, asked = data()
    vectors, queries = frames(spark, ids, matrix, asked)
    found = search.top_k(vectors, queries, 400, metric="cosine")
    assert ranked(found) == brute(ids, matrix, asked, 400, cosine=True)
    first = found.filter("query_id = 0 AND rank = 1").first()
    assert first.distance == pytest.approx(0, abs=1e-8)


def test_string_ids_and_null_vectors(spark):
    ids, matrix, asked = data(60, 20)
    vectors, queries = frames(spark, ids, matrix, asked)
    named = vectors.withColumn("vec_id", F.lpad(F.col("vec_id").cast("string"), 4, "0"))
    named = named.unionByName(spark.createDataFrame([("9999", None)], "vec_id string, embedding array<float>"))
    found = ranked(search.top_k(named, queries, 10))
    assert {q: [int(i) for i in v] for q, v in found.items()} == brute(ids, matrix, asked, 10)


def test_more_queries_than_a_tile(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERY_TILE", 3)
    ids, matrix, asked = data(80, 20, queries=10)
    vectors, queries = frames(spark, ids, matrix, asked)
    assert ranked(search.top_k(vectors, queries, 4)) == brute(ids, matrix, asked, 4)
    coded = lsh.add_codes(vectors, DIM, bits=0, tables=1)
    found = lsh.lsh_search(coded, queries, 4, bits=0, tables=1)
    assert ranked(found) == brute(ids, matrix, asked, 4)


def test_query_ids_and_sizes_are_checked(spark, monkeypatch):
    ids, matrix, asked = data(queries=40)
    vectors, queries = frames(spark, ids, matrix, asked)
    with pytest.raises(ValueError, match="unique"):
        search.top_k(vectors, queries.unionByName(queries.limit(1)), 4)
    monkeypatch.setattr(search, "MAX_QUERY_BYTES", 40 * DIM * 8 - 1)
    with pytest.raises(ValueError, match="at most"):
        search.top_k(vectors, queries, 4)


def test_vectors_that_are_not_finite_never_match(spark):
    ids, matrix, asked = data()
    bad = matrix.copy()
    bad[120:140, 2], bad[140:150, 0] = np.nan, np.inf
    vectors, queries = frames(spark, ids, bad, asked)
    extra = spark.createDataFrame([(-1, None), (-2, [float("nan")] * DIM)], VECTORS)
    asked_bad = queries.unionByName(spark.createDataFrame([(90, [float("inf")] * DIM), (91, None)], QUERIES))
    keep = np.r_[0:120, 150:len(ids)]
    exact = brute(ids[keep], matrix[keep], asked, 9)
    rows = vectors.unionByName(extra)
    assert ranked(search.top_k(rows, asked_bad, 9)) == exact
    one = search.nearest(rows, [float(x) for x in asked[1]], 9).collect()
    assert [r.vec_id for r in one] == exact[1]
    centroids = ivf.train_centroids(rows, lists=3)
    assigned = ivf.assign_lists(rows, centroids)
    assert assigned.filter("list_id IS NULL").count() == 32
    assert ranked(ivf.ivf_search(assigned, centroids, asked_bad, 9, probes=3)) == exact
    coded = lsh.add_codes(rows, DIM, bits=0, tables=1)
    assert coded.filter("codes IS NULL").count() == 32
    assert ranked(lsh.lsh_search(coded, asked_bad, 9, bits=0, tables=1)) == exact


@pytest.mark.parametrize("scale", [1e-8, 1.0, 1e6])
def test_rank_does_not_depend_on_the_scale(spark, scale):
    ids, matrix, asked = data(hot=0)
    plain = frames(spark, ids, matrix, asked)
    scaled = frames(spark, ids, matrix * np.float32(scale), asked)
    exact = {q: found for q, found in ranked(search.top_k(*plain, 7)).items()}
    assert ranked(search.top_k(*scaled, 7)) == exact


def test_no_queries(spark):
    ids, matrix, asked = data(20, 5)
    vectors, queries = frames(spark, ids, matrix, asked)
    assert search.top_k(vectors, queries.limit(0), 3).count() == 0
    assert lsh.lsh_search(lsh.add_codes(vectors, DIM), queries.limit(0), 3).count() == 0


def test_wrong_arguments(spark):
    ids, matrix, asked = data(20, 5)
    vectors, queries = frames(spark, ids, matrix, asked)
    with pytest.raises(ValueError):
        search.top_k(vectors, queries, 3, metric="l1")
    with pytest.raises(ValueError):
        search.top_k(vectors, queries, 0)
    short = vectors.withColumn("embedding", F.slice("embedding", 1, DIM - 1))
    with pytest.raises(Exception, match="expected vectors of 8 elements"):
        search.top_k(short, queries, 3).collect()


def test_one_query_by_sort_and_limit(spark):
    ids, matrix, asked = data()
    vectors, _ = frames(spark, ids, matrix, asked)
    found = search.nearest(vectors, [float(x) for x in asked[1]], 6).collect()
    assert [r.vec_id for r in found] == brute(ids, matrix, asked, 6)[1]


def test_ivf_all_lists_are_exact_and_few_lists_are_a_part(spark, folder):
    ids, matrix, asked = data()
    vectors, queries = frames(spark, ids, matrix, asked)
    centroids = ivf.train_centroids(vectors, lists=6)
    assigned = ivf.assign_lists(vectors, centroids)
    ivf.write_index(assigned, folder + "/index")
    index = ivf.read_index(spark, folder + "/index")
    assert index.count() == len(ids)
    exact = search.top_k(vectors, queries, 9)
    assert ranked(ivf.ivf_search(index, centroids, queries, 9, probes=6)) == ranked(exact)

    list_ids, centers = ivf.centroid_matrix(centroids)
    lists = {r.vec_id: r.list_id for r in assigned.collect()}
    products = np.round(matrix.astype(np.float64) @ centers.T, 9)
    assert lists == {int(i): int(list_ids[p.argmax()]) for i, p in zip(ids, products)}
    scores = np.round(asked.astype(np.float64) @ centers.T, 9)
    probed = [set(list_ids[np.argsort(-s, kind="stable")[:2]]) for s in scores]
    found = ivf.ivf_search(index, centroids, queries, 9, probes=2)
    assert ranked(found) == brute(
        ids, matrix, asked, 9, allowed=lambda q, i: lists[i] in probed[q]
    )
    recall = search.recall(found, exact, "query_id", "vec_id").collect()
    assert all(0 <= r.recall <= 1 and r.wanted == 9 for r in recall)


def test_lsh(spark):
    ids, matrix, asked = data()
    vectors, queries = frames(spark, ids, matrix, asked)
    none = lsh.add_codes(vectors, DIM, bits=0, tables=1)
    assert ranked(lsh.lsh_search(none, queries, 9, bits=0, tables=1)) == brute(ids, matrix, asked, 9)

    coded = lsh.add_codes(vectors, DIM, bits=3, tables=2)
    planes = lsh.projections(DIM, 3, 2)
    stored = dict(zip(map(int, ids), lsh.bucket_codes(matrix.astype(np.float64), planes)))
    wanted = lsh.bucket_codes(asked.astype(np.float64), planes)
    assert {r.vec_id: r.codes for r in coded.collect()} == {i: c.tolist() for i, c in stored.items()}
    assert ranked(lsh.lsh_search(coded, queries, 9, bits=3, tables=2, probes=1)) == brute(
        ids, matrix, asked, 9, allowed=lambda q, i: bool((stored[i] == wanted[q]).any())
    )


def test_index_choice(spark):
    ids, matrix, asked = data(60, 20)
    vectors, queries = frames(spark, ids, matrix, asked)
    exact = brute(ids, matrix, asked, 5)
    assert ranked(VectorIndex(vectors, "exact", DIM).search(queries, 5)) == exact
    assert ranked(VectorIndex(vectors, "lsh", DIM, bits=0).search(queries, 5)) == exact
    assert ranked(VectorIndex(vectors, "ivf", DIM, lists=3).search(queries, 5, probes=3)) == exact
    with pytest.raises(ValueError):
        VectorIndex(vectors, "hnsw2", DIM)


def test_many_lists_are_trained_cell_by_cell(spark, monkeypatch):
    draw, asked, kmeans = np.random.default_rng(3), [], ivf.KMeans
    matrix = draw.normal(size=(600, DIM)).astype(np.float32)
    matrix[500:] = matrix[0]  # copies
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)]
    rows += [(700, None), (701, [0.0] * DIM), (702, [float("nan")] * DIM)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(ivf, "KMeans", lambda k, **more: asked.append(k) or kmeans(k=k, **more))

    def lost(centroids):
        _, centers = ivf.centroid_matrix(centroids)
        units = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
        return len(centers), ((units[:, None] - centers) ** 2).sum(axis=2).min(axis=1).sum()

    flat = lost(ivf.train_centroids(vectors, 60))
    monkeypatch.setattr(ivf, "MAX_FLAT_LISTS", 16, raising=False)
    some = lost(ivf.train_centroids(vectors, 60))
    assert asked == [60, 8] and flat[0] <= 60 == some[0] and some[1] < 1.15 * flat[1]
    ids, centers = ivf.centroid_matrix(ivf.train_centroids(vectors, 2000))
    assert len(ids) == 500 and np.allclose(np.linalg.norm(centers, axis=1), 1)  # each different vector


def test_many_lists_share_folders(spark, folder, monkeypatch):
    ids, matrix, asked = data()
    vectors, queries = frames(spark, ids, matrix, asked)
    monkeypatch.setattr(ivf, "MAX_FOLDERS", 16, raising=False)
    monkeypatch.setattr(ivf, "FOLDER_LISTS", 5, raising=False)
    monkeypatch.setattr(ivf, "MAX_FLAT_LISTS", 16, raising=False)
    index = VectorIndex(vectors, "ivf", DIM, lists=30, path=folder + "/index")
    names = [p.name for p in pathlib.Path(folder, "index").iterdir() if p.is_dir()]
    assert len(names) <= 7 and index.rows.count() == vectors.count()
    list_ids, centers = ivf.centroid_matrix(index.centroids)
    lists = {r.vec_id: r.list_id for r in index.rows.collect()}
    scores = np.round(asked.astype(np.float64) @ centers.T, 9)
    probed = [set(list_ids[np.argsort(-s, kind="stable")[:3]]) for s in scores]
    assert ranked(index.search(queries, 9, probes=3)) == brute(
        ids, matrix, asked, 9, allowed=lambda q, i: lists[i] in probed[q]
    )
    plan = index.search(queries.limit(1), 3, probes=1)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*list_folder#\d+ = \d", plan)


def test_ivf_reads_probed_lists_only(spark, folder):
    ids, matrix, asked = data()
    vectors, queries = frames(spark, ids, matrix, asked)
    centroids = ivf.train_centroids(vectors, lists=6)
    ivf.write_index(ivf.assign_lists(vectors, centroids), folder + "/index")
    found = ivf.ivf_search(
        ivf.read_index(spark, folder + "/index"), centroids, queries.limit(1), 3, probes=1
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*list_id#\d+ = \d", plan)
    assert "Join" not in plan and "Cartesian" not in plan


def _stored(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    asked = rows.filter("vec_id % 50 = 0").selectExpr("vec_id AS query_id", "embedding AS query_vector")
    return rows, asked, search.top_k(rows, asked, 10)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_registered_indexes_find_nine_of_ten(spark, sf):
    for name in ("ivf_recall", "lsh_recall", "pq_recall"):
        found = queries_of_plans.QUERIES[name](spark, f"/root/testdata/{sf}")
        assert found.agg({"recall": "avg"}).first()[0] >= 0.9


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_calibrated_indexes_find_nine_of_ten_and_read_less(spark, sf, folder):
    rows, asked, exact = _stored(spark, sf)
    n = rows.count()
    index = VectorIndex(rows, "ivf", 64, lists=n // 12, path=folder + "/ivf")
    found = search.recall(index.search(asked, 10), exact, "query_id", "vec_id")
    assert found.agg({"recall": "avg"}).first()[0] >= 0.9 and index.probes < 0.8 * (n // 12)
    index = VectorIndex(rows, "lsh", 64, path=folder + "/lsh")
    found = search.recall(index.search(asked, 10), exact, "query_id", "vec_id")
    assert found.agg({"recall": "avg"}).first()[0] >= 0.9 and index.probes <= 20


def test_buckets_on_disk_give_what_codes_give(spark, folder):
    rows, asked, _ = _stored(spark, "sf0.01")
    coded = lsh.add_codes(rows, 64, bits=4, tables=3)
    lsh.write_buckets(coded, folder + "/lsh")
    index = lsh.read_buckets(spark, folder + "/lsh")
    for probes in (1, 3, 16):
        one = lsh.lsh_search(index, asked, 7, bits=4, tables=3, probes=probes)
        other = lsh.lsh_search(coded, asked, 7, bits=4, tables=3, probes=probes)
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))
    some = asked.limit(1)
    plan = lsh.lsh_search(index, some, 7, bits=4, tables=3, probes=1)._jdf.queryExecution().executedPlan().toString()
    assert "lsh_code" in plan.split("PartitionFilters")[1].split("]")[0]


def test_order_of_buckets():
    planes = lsh.projections(8, 3, 2)
    matrix = np.random.default_rng(3).normal(size=(5, 8))
    ranks = lsh.bucket_ranks(matrix, planes)
    own = lsh.bucket_codes(matrix, planes)
    for q in range(5):
        for t in range(2):
            margins = planes[t] @ matrix[q]
            cost = [sum(m * m for b, m in enumerate(margins) if (m >= 0) != bool(c >> b & 1)) for c in range(8)]
            assert list(ranks[q, t].argsort()) == sorted(range(8), key=lambda c: cost[c]) and ranks[q, t, own[q, t]] == 0
    assert 530 < search.needed_probes(np.arange(1000), 0.5) < 570 and search.needed_probes(np.array([0, 5]), 1.0) == 6
    assert lsh.bits_for(10) == lsh.BITS and lsh.bits_for(1 << 24) == 9 and lsh.bits_for(1 << 40) == lsh.MAX_BITS


def test_bounded_search_is_exact_and_skips_lists(spark, folder):
    rng = np.random.default_rng(12)
    centers = rng.normal(size=(12, DIM))
    centers /= np.linalg.norm(centers, axis=1)[:, None]
    matrix = centers[rng.integers(0, 12, 400)] + rng.normal(size=(400, DIM)) * 0.05
    matrix = (matrix / np.linalg.norm(matrix, axis=1)[:, None]).astype(np.float32)
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(matrix)], VECTORS)
    rows = rows.unionByName(spark.createDataFrame([(900, None), (901, [float("nan")] * DIM)], VECTORS))
    queries = spark.createDataFrame([(i, [float(x) for x in centers[i]]) for i in range(6)], QUERIES)
    centroids = ivf.train_centroids(rows, 12)
    index = ivf.assign_lists(rows, centroids)
    ivf.write_index(index, folder + "/ivf")
    index = ivf.read_index(spark, folder + "/ivf")
    radii = ivf.list_radii(index, centroids)
    for first in (1, 4):
        found = ivf.bounded_search(index, centroids, radii, queries, 5, first=first)
        assert ranked(found.drop("lists_read")) == ranked(search.top_k(rows, queries, 5))
        assert max(r.lists_read for r in found.collect()) < 10
    assert ivf.bounded_search(index, centroids, radii, queries.limit(0), 5).count() == 0


def test_join_in_tiles_gives_what_one_search_gives(spark):
    rows, asked, _ = _stored(spark, "sf0.01")
    asked = asked.selectExpr("query_id", "cast(query_vector AS array<double>) AS query_vector")
    whole = sorted(map(tuple, search.top_k(rows, asked, 4).collect()))
    assert sorted(map(tuple, search.knn_join(rows, asked, 4, tile_bytes=64 * 8 * 3).collect())) == whole
    assert sorted(map(tuple, search.knn_join(rows, asked, 4).collect())) == whole
    assert search.knn_join(rows, asked.limit(0), 4).count() == 0


def test_product_quantisation(spark):
    rows, asked, exact = _stored(spark, "sf0.01")
    n = rows.count()
    book = pq.train_book(rows, 64)
    odd = rows.unionByName(spark.createDataFrame([(9000, None, 0), (9001, [float("inf")] * 64, 0)], rows.schema))
    coded = pq.add_codes(odd, book).select("vec_id", "code")
    assert coded.filter("code IS NULL").count() == 2 and coded.filter("length(code) = 16").count() == n
    known = {r.vec_id: np.array(r.embedding) for r in rows.collect()}
    for r in pq.decoded(coded, book).limit(20).collect():
        parts, rough = known[r.vec_id].reshape(16, 4), np.array(r.rough).reshape(16, 4)
        for s in range(16):
            assert np.allclose(((book[s] - parts[s]) ** 2).sum(1).min(), ((rough[s] - parts[s]) ** 2).sum(), atol=1e-5)
    whole = pq.pq_search(coded, odd, book, asked, 10, refine=n // 10 + 1)  # all rows are rough matches
    near = lambda df: {(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in df.collect()}
    assert near(whole) == near(exact)
    assert pq.pq_search(coded, odd, book, asked.limit(0), 5).count() == 0
    assert pq.train_book(rows.limit(0), 64).shape == (16, 16, 4)
    with pytest.raises(ValueError):
        pq.train_book(rows, 64, slices=7)


def _peak(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_an_index_does_not_follow_lists_times_rows():
    """What a task holds follows its rows or its lists, not their product."""
    draw = np.random.default_rng(3)
    rows, centers = draw.normal(size=(6000, 8)), draw.normal(size=(5000, 8))
    first, peak = _peak(lambda: search.highest_products(rows, centers, 1))
    assert peak < 100 << 20 and (first[:50, 0] == (rows[:50] @ centers.T).argmax(axis=1)).all()
    bits, peak = _peak(lambda: search.among_highest(rows[:2000], centers, 3000))
    assert peak < 100 << 20
    chosen = search.highest_products(rows[:40], np.vstack([centers, centers[:9]]), 3000)
    same = np.unpackbits(search.among_highest(rows[:40], np.vstack([centers, centers[:9]]), 3000), axis=1, count=5009)
    assert all(set(chosen[i]) == set(np.flatnonzero(same[i])) for i in range(40))
    # Rows of two tables of buckets, asked by many queries: a mask for some queries at a time.
    probed = draw.random((8000, 2, 32)) < 0.6
    codes = draw.integers(0, 32, (4000, 2))
    batch = pa.RecordBatch.from_arrays([
        pa.array(range(4000)), pa.array(draw.normal(size=(4000, 8)).tolist()), pa.array(codes.tolist()),
        pa.array([i % 2 for i in range(4000)]), pa.array(codes[range(4000), [i % 2 for i in range(4000)]]),
    ], ["vec_id", "embedding", "codes", "lsh_table", "lsh_code"])
    asked = draw.normal(size=(8000, 8))
    best = search._Best(search.Queries(np.arange(8000).astype(object), asked, {"probed": probed}), 2, "inner_product")
    _, peak = _peak(lambda: best.add(batch, lsh._first_bucket))
    assert peak < 70 << 20 and all(len(names) == 2 for names in best.found)


def test_many_queries_are_asked_in_tiles(spark, monkeypatch):
    draw = random.Random(8)
    rows = spark.createDataFrame([(i, [draw.gauss(0, 1) for _ in range(DIM)]) for i in range(600)], VECTORS)
    asked = rows.selectExpr("vec_id AS query_id", "embedding AS query_vector")
    centroids = ivf.train_centroids(rows, 12)
    index = ivf.assign_lists(rows, centroids)
    once = ivf.ivf_search(index, centroids, asked, 3, 5)
    monkeypatch.setattr(ivf, "MAX_PROBE_BYTES", 1)
    assert sorted(map(tuple, ivf.ivf_search(index, centroids, asked, 3, 5).collect())) == sorted(map(tuple, once.collect()))
