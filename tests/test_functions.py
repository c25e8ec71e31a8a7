import os.path
import struct

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from inkspan.functions import messages, text, times, vectors


def values(spark, rows, ddl, column):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {ddl}")
    return [r.c for r in frame.select("i", column.alias("c")).orderBy("i").collect()]


def test_strip_is_python_strip(spark):
    rows = [" a ", "　日 本　", "\x1c\x1fa\x85", "\t\n", "", "a b", "​a"]
    assert values(spark, rows, "string", text.strip("v")) == [r.strip() for r in rows]
    assert values(spark, rows, "string", text.is_blank("v")) == [not r.strip() for r in rows]


def test_paths(spark):
    rows = ["a/b/c.pdf", "a.tar.pdf", ".pdf", "noext", "dir.v1/b", "a..pdf", "..a.pdf", "a.", "..."]
    assert values(spark, rows, "string", text.stem("v")) == [os.path.splitext(r)[0] for r in rows]
    assert values(spark, rows, "string", text.basename("v")) == [os.path.basename(r) for r in rows]
    assert values(spark, ["x/a.pdf"], "string", text.with_extension("v", ".csv")) == ["x/a.csv"]
    assert values(spark, ["a\\b"], "string", text.forward_slashes("v")) == ["a/b"]


def test_suffix(spark):
    names = ["a.pdf", "b.PDF", "c.txt"]
    assert values(spark, names, "string", text.has_suffix("v", ".pdf")) == [True, False, False]
    assert values(spark, names, "string", text.has_suffix("v", ".pdf", True)) == [
        True, True, False,
    ]


def test_preview_counts_characters(spark):
    assert values(spark, ["日本語" * 50], "string", text.preview("v", 4)) == ["日本語日"]


def pair(spark, a, b, fn):
    frame = spark.createDataFrame([(a, b)], "a array<float>, b array<float>")
    return frame.select(fn("a", "b").alias("c")).first().c


def test_distances(spark):
    v = [0.6, 0.8]
    assert pair(spark, v, [1.0, 0.0], vectors.negative_inner_product) == pytest.approx(-0.6)
    assert pair(spark, v, [1.0, 0.0], vectors.cosine_distance) == pytest.approx(0.4)
    assert pair(spark, v, v, vectors.negative_inner_product) == pytest.approx(-1)
    assert pair(spark, v, v, vectors.cosine_distance) == pytest.approx(0, abs=1e-12)
    assert pair(spark, v, [0.0, 0.0], vectors.cosine_distance) is None


def test_norms(spark):
    rows = [[0.6, 0.8], [3.0, 4.0], [0.0, 0.0]]
    assert values(spark, rows, "array<float>", vectors.norm("v")) == pytest.approx([1, 5, 0])
    assert values(spark, rows, "array<float>", vectors.is_normalized("v")) == [True, False, False]


def test_vector_text(spark):
    rows = ["[1.5,-2e-3]", "[]", "nonsense", None]
    assert values(spark, rows, "string", vectors.parse_vector("v")) == [
        [1.5, pytest.approx(-0.002)], [], None, None,
    ]
    assert values(spark, [[1.5, 2.0]], "array<float>", vectors.format_vector("v")) == ["[1.5,2.0]"]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(width=32, allow_nan=False), min_size=200, max_size=200))
def test_half_rounding_and_bits(spark, numbers):
    numbers += [0.0, -0.0, 65519.9, 65520.0, -65520.0, 2.0**-24, 2.0**-25, 2.0**-14, 1e-40, 0.6]
    numbers = [float(np.float32(x)) for x in numbers]
    with np.errstate(over="ignore"):
        halves = np.array(numbers, dtype=np.float64).astype(np.float16)
    found = values(spark, numbers, "double", vectors.round_half(F.col("v")))
    assert found == [float(h) for h in halves]
    bits32 = values(spark, numbers, "double", vectors.float_bits(F.col("v")))
    assert bits32 == [struct.pack("<f", x).hex() for x in numbers]
    bits16 = values(spark, numbers, "double", vectors.half_bits(F.col("v")))
    assert bits16 == [struct.pack("<e", h).hex() for h in halves]


def test_half_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [[float(x) for x in np.float32(rng.normal(size=n) * 10.0 ** rng.integers(-6, 6))]
            for n in (3, 0, 5)] + [None, [70000.0]]
    halves = [None if r is None else [float(np.float16(x)) for x in r] for r in rows[:-1]]
    assert values(spark, rows, "array<float>", vectors.to_half("v")) == halves + [[float("inf")]]
    per_element = F.transform("v", vectors.round_half)
    assert values(spark, rows, "array<float>", per_element) == halves + [[float("inf")]]
    errors = [max((abs(a - b) for a, b in zip(r or [], h or [])), default=None)
              for r, h in zip(rows, halves)]
    assert values(spark, rows, "array<float>", vectors.half_error("v")) == errors + [float("inf")]


def test_big_endian_bits(spark):
    assert values(spark, [0.6], "float", vectors.float_bits(F.col("v"), "big")) == ["3f19999a"]
    with pytest.raises(ValueError):
        vectors.float_bits(F.col("v"), "middle")


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        wall = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS w")
        row = wall.select(
            times.zoned_text(times.utc_instant("w")).alias("jst"),
            times.zoned_text(times.utc_instant("w"), "UTC", "UTC").alias("utc"),
            times.unix_seconds(times.utc_instant("w")).alias("seconds"),
        ).select(
            "*", times.unix_text("seconds").alias("shown"),
            times.parse_unix(times.unix_text("seconds")).alias("again"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (
        "2024-01-01 09:00:00 JST", "2024-01-01 00:00:00 UTC",
        1704067200, "2024-01-01 00:00:00", 1704067200,
    )


def test_event_keys(spark):
    body = (
        '{"Records":[{"eventVersion":"2.1","s3":{"bucket":{"name":"b"},"object":{"key":"t.pdf",'
        '"size":1}}},{"s3":{"object":{"key":"u.pdf"}}}]}'
    )
    rows = [body, '{"Records":[]}', "broken", None]
    assert values(spark, rows, "string", messages.event_key("v")) == ["t.pdf", None, None, None]
    assert values(spark, rows, "string", messages.event_keys("v"))[0] == ["t.pdf", "u.pdf"]


def test_body_round_trip(spark):
    rows = ['a "b".pdf', "日本.pdf"]
    assert values(
        spark, rows, "string", messages.event_key(messages.notification_body("bucket", "v"))
    ) == rows
    assert values(spark, [None], "string", messages.event_key(
        messages.notification_body("bucket", "v", F.lit("fallback"))
    )) == ["fallback"]
