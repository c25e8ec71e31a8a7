import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from inkspan.functions.splitting import chunk_array, line_array, page_chunk_array


def model(text, size, overlap, separator):
    """The splitting rules, piece by piece."""
    parts = [p for p in (text.split(separator) if separator else text) if p]
    sep, chunks, current, total = len(separator), [], [], 0

    def emit():
        chunk = separator.join(current).strip()
        if chunk:
            chunks.append(chunk)

    for part in parts:
        if current and total + sep + len(part) > size:
            emit()
            while total > overlap or (
                total > 0 and total + len(part) + (sep if current else 0) > size
            ):
                total -= len(current[0]) + (sep if len(current) > 1 else 0)
                current = current[1:]
        current.append(part)
        total += len(part) + (sep if len(current) > 1 else 0)
    if current:
        emit()
    return chunks


GOLDEN = [
    ("a\n\nb\n\nc", "\n\n", 1000, 0, ["a\n\nb\n\nc"]),
    ("aaaa\n\nbbbb\n\ncccc", "\n\n", 10, 0, ["aaaa\n\nbbbb", "cccc"]),
    ("aaaa\n\nbbbb\n\ncccc", "\n\n", 10, 4, ["aaaa\n\nbbbb", "bbbb\n\ncccc"]),
    ("x" * 15, "\n\n", 10, 0, ["x" * 15]),
    ("x" * 15 + "\n\nyy", "\n\n", 10, 0, ["x" * 15, "yy"]),
    ("", "\n\n", 1000, 0, []),
    ("  \n\n  ", "\n\n", 1000, 0, []),
    ("\n\n\n\na", "\n\n", 1000, 0, ["a"]),
    ("　日本　\n\n語", "\n\n", 1000, 0, ["日本　\n\n語"]),
    ("aa|bb|cc|dd", "|", 5, 2, ["aa|bb", "bb|cc", "cc|dd"]),
    ("a\nb", "\n\n", 1000, 0, ["a\nb"]),
    ("a.b", "", 2, 1, ["a.", ".b"]),
    ("a\\Eb\\Ec", "\\E", 3, 0, ["a", "b", "c"]),
    ("😀😀|😀", "|", 3, 0, ["😀😀", "😀"]),
]


def split(spark, texts, column):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.c for r in rows.select("i", column.alias("c")).orderBy("i").collect()]


def test_golden_cases(spark):
    for text, separator, size, overlap, chunks in GOLDEN:
        assert split(spark, [text], chunk_array("text", size, overlap, separator)) == [chunks]
        assert model(text, size, overlap, separator) == chunks


@pytest.mark.parametrize(
    "size, overlap, separator",
    [(10, 0, "\n"), (10, 4, "\n"), (5, 5, "\n"), (20, 7, "||"), (1, 0, "\n"), (7, 3, "\n\n")],
)
@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.text("ab 語　\n|\x1c😀", max_size=60), min_size=40, max_size=40))
def test_equals_the_model(spark, size, overlap, separator, texts):
    found = split(spark, texts, chunk_array("text", size, overlap, separator))
    assert found == [model(t, size, overlap, separator) for t in texts]


def test_page_that_yields_no_chunk(spark):
    texts = ["||", "", " \n", "a|b"]
    assert split(spark, texts, page_chunk_array("text", 10, 0, "|")) == [
        ["||"], [], [], ["a|b"],
    ]


def test_lines(spark):
    texts = ["l1\n\n l2 \n", "", " \n ", "　x"]
    assert split(spark, texts, line_array("text")) == [["l1", "l2"], [], [" \n "], ["x"]]


def test_sizes_are_checked(spark):
    with pytest.raises(ValueError):
        chunk_array("text", 0)
    with pytest.raises(ValueError):
        chunk_array("text", 5, 6)


def test_long_page(spark):
    text = "\n".join(f"line {i}" for i in range(30000))
    row = spark.createDataFrame([(text,)], "text string").select(
        chunk_array("text", 100, 20, "\n").alias("c")
    ).select(F.size("c").alias("n"), F.element_at("c", -1).alias("last")).first()
    expected = model(text, 100, 20, "\n")
    assert (row.n, row.last) == (len(expected), expected[-1])


@pytest.mark.parametrize("overlap", [0, 6])
def test_a_page_of_many_chunks(spark, overlap):
    text = "\n".join(f"line{i:06d}" for i in range(20_000))
    found = split(spark, [text], chunk_array("text", 20, overlap, "\n"))[0]
    assert found == model(text, 20, overlap, "\n") and len(found) == 20_000
