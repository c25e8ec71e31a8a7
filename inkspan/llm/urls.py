"""URL filter: fixed rules first, then logistic regression on hashed character n-grams.

DataFrame functions and DataFrame-based ML only. Host and path are cut with
built-in functions, their n-grams come from one regular expression per length,
and the model is trained on a small table of labelled URLs.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LENGTHS = (3, 4, 5)
FEATURES = 1 << 16
#: Most labelled URLs that a model is fitted to.
LABELLED_ROWS = 100_000
#: Share of bad URLs that is expected, whatever their share of the labelled table: a URL
#: of which nothing is known is allowed.
BAD_SHARE = 0.1


@dataclass(frozen=True)
class UrlRule:
    """Fits the host and its subdomains if the path starts with the rule's path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to / ? # or the end, A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_fits(rule: UrlRule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(
        path, F.lit(rule.path)
    )


def longest_rule(rules: Sequence[UrlRule], host: Column, path: Column) -> Column:
    """Name and verdict of the longest rule that fits, else null; the rules are few."""
    first = sorted(rules, key=lambda r: (-len(r.name), r.name))
    return F.coalesce(*(
        F.when(rule_fits(r, host, path), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in first
    ), F.lit(None).cast("struct<rule:string,verdict:string>"))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams, marked by the part they come from; ^ and $ close each part."""
    def of(mark: str, part: Column) -> list[Column]:
        closed = F.concat(F.lit("^"), part, F.lit("$"))
        return [
            F.transform(
                F.regexp_extract_all(closed, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)),
                lambda gram: F.concat(F.lit(mark), gram),
            )
            for n in LENGTHS
        ]

    return F.concat(*of("h:", host), *of("p:", path))


def _parts(urls: DataFrame, url_col: str) -> DataFrame:
    return urls.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "block") -> PipelineModel:
    """A model of a labelled table: label 1 means block.

    At most ``LABELLED_ROWS`` rows count, those of the smallest hash.
    """
    few = labelled.select(url_col, label_col).orderBy(F.xxhash64(url_col), url_col).limit(LABELLED_ROWS)
    rows = _parts(few, url_col).select(
        grams(F.col("host"), F.col("path")).alias("grams"), F.col(label_col).cast("double").alias("label")
    )
    hashing = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
    rows = hashing.transform(rows)
    bad = rows.agg(F.avg("label")).first()[0] or 0.0
    weight = F.when(F.col("label") == 1, BAD_SHARE / max(bad, 1e-9)).otherwise((1 - BAD_SHARE) / max(1 - bad, 1e-9))
    regression = LogisticRegression(regParam=0.01, maxIter=50, standardization=False, weightCol="weight")
    fitted = regression.fit(rows.withColumn("weight", weight))
    return PipelineModel([hashing, fitted])


def judge(
    pages: DataFrame, rules: Sequence[UrlRule], model: PipelineModel,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per page: its id, host, path, rule, verdict and the score of the model.

    A null URL or one without ``://`` has an empty host and path, which no rule
    with a host fits; the model judges it. Repeated rows and null ids stay.
    """
    rows = _parts(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")), "url")
    rows = rows.select(
        "page_id", "host", "path",
        longest_rule(rules, F.col("host"), F.col("path")).alias("ruled"),
        grams(F.col("host"), F.col("path")).alias("grams"),
    )
    scored = model.transform(rows)
    score = vector_to_array("probability")[1]
    return scored.select(
        "page_id", "host", "path",
        F.col("ruled.rule").alias("rule"),
        F.coalesce("ruled.verdict", F.when(score >= 0.5, "block").otherwise("allow")).alias("verdict"),
        score.alias("score"),
    )
