"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm import fingerprints, language, lines, mixing, pieces, pii, quality, resampling, secrets, simhash, spelling, toxicity, urls
from inkspan.llm.common import held_out, table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = language.train(docs.where(~held_out()))
    return language.identify(docs, prototypes).withColumn("held_out", held_out())


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edited(table(spark, sf_dir, "documents"))


#: Rules of the URL filter: host, start of the path, verdict.
URL_RULES = (
    urls.UrlRule("com", "/", "allow"),
    urls.UrlRule("example.com", "/en/", "block"),
    urls.UrlRule("www.example.com", "/en/", "allow"),
    urls.UrlRule("net", "/es/", "block"),
    urls.UrlRule("net", "/fr/", "block"),
)

#: Labelled URLs: names of sites that sell and bet, and names of plain ones.
BLOCKED_SITES = (
    "buy-pills-now", "best-pills-online", "pill-store", "pharma-cheap", "casino-royal",
    "online-casino", "mega-casino", "bet-free", "sure-bets", "sports-betting",
    "lottery-win", "win-big", "poker-win", "slots-free", "adult-cams", "xxx-videos", "hot-singles",
    "porn-free", "loan-fast", "quick-loans", "payday-cash", "replica-watches", "cheap-replica",
    "crypto-double", "get-rich-fast", "free-followers", "viagra-cheap", "weight-loss-miracle",
    "adult-video", "spam-mail", "link-farm", "ad-tracker", "popup-ads", "sell-pills", "win-jackpot",
)
ALLOWED_SITES = (
    "city-library", "river-museum", "math-notes", "daily-news", "weather-report", "open-science",
    "cooking-school", "garden-guide", "history-archive", "local-council", "book-review",
    "linux-docs", "python-tutorial", "travel-journal", "bird-watch", "music-theory", "film-critic",
    "health-advice", "law-review", "chess-club", "stone-works", "old-harbour", "green-hill",
    "north-wind", "letters-home", "the-lantern", "winterthur", "lindenhof", "brightwater", "atelier",
    "marchand", "solana", "querida", "weaver", "fairfield",
)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """Each site under several hosts and paths, so that only its name tells it apart."""
    sites = [(s, 1) for s in BLOCKED_SITES] + [(s, 0) for s in ALLOWED_SITES]
    names = spark.createDataFrame(sites, "site string, block int")
    hosts = names.withColumn("sub", F.explode(F.array(*map(F.lit, ("", "www.", "m.", "blog.")))))
    hosts = hosts.withColumn("top", F.explode(F.array(*map(F.lit, ("com", "net", "org")))))
    hosts = hosts.withColumn("lang", F.explode(F.array(*map(F.lit, ("en", "de", "fr", "es")))))
    number = F.pmod(F.xxhash64("site", "sub", "top", "lang"), F.lit(9000)).cast("string")
    url = F.concat(
        F.lit("https://"), "sub", "site", F.lit(".example."), "top", F.lit("/"), "lang", F.lit("/"), number
    )
    return hosts.select(url.alias("url"), "block")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = urls.train(labelled_urls(spark))
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES, model)


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"), simhash.SHORT)
    return groups.select("doc_id", F.lower(F.hex("sketch")).alias("fingerprint"), "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.classes(table(spark, sf_dir, "documents"), short=True).drop("mark", "is_long", "is_new")


def op7_sentencepiece(
    spark: SparkSession, sf_dir: str, vocabulary: str = pieces.VOCABULARY
) -> DataFrame:
    return tokenized(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary).drop("text")


def tokenized(docs: DataFrame, path: str = pieces.VOCABULARY) -> DataFrame:
    """The documents with piece_ids, n_pieces and whether decoding gives the text back."""
    vocabulary = pieces.Vocabulary.read(path)
    rows = pieces.encode_and_decode(docs, vocabulary)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return rows.select(
        *docs.columns, "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"),
        same.alias("round_trip"),
    )


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    labels = table(spark, sf_dir, "labels").where(~held_out())
    return toxicity.train(toxicity.labelled(docs, labels))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", "passages")


#: Version of the policy that decides in op9.
QUALITY_POLICY = "v2"


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    return quality.apply_policy(rows, QUALITY_POLICY).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality.fails(quality.POLICIES["base"]).alias("base_failed"), "kept", "failures",
    )


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the policy of op9 rejects, rejects alone, and the yield without it."""
    return quality.ablations(quality.ledger(table(spark, sf_dir, "documents")), QUALITY_POLICY)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mix_sources, op2_language_id, op3_fingerprints, op4_url_filter, op5_simhash_dedup,
        op6_line_dedup, op7_sentencepiece, op8_toxicity, op9_quality_rules, op10_secret_scan,
        op11_importance_resampling, op12_spelling_variants, op13_personal_data,
        quality_ablations,
    )
}
