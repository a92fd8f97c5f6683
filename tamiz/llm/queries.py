"""The registered queries of this package and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    embedding_dedup,
    hard_negatives,
    language,
    licenses,
    mixing,
    ngram_join,
    periodic_runs,
    pieces,
    sharding,
    substring_dedup,
    topk,
    toxicity,
    url_filter,
)
from . import sql as oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> str:
    """The installed public model; executors have the same installation."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op1_language")
def op1_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"), piece_model())


#: (host, path, verdict): fixed values of the query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query("op2_url_filter", oracle.URL_FILTER)
def op2_url_filter(spark, sf_dir):
    """The list holds the URLs that were spread with a feed's tracking parameter; it grows with ``pages``."""
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, pages.where(F.col("url").contains("utm_source=")).select("url"), RULES)


@query("op3_mixing")
def op3_mixing(spark, sf_dir):
    """Target weights: the square roots of the sources' sizes."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op4_licenses", oracle.LICENSES)
def op4_licenses(spark, sf_dir):
    """Documents as files: source / thousand / fifty / name; the first of each directory is its licence file."""
    i = F.col("doc_id")
    name = (
        F.when(i % 1000 == 0, F.lit("LICENSE"))
        .when(i % 50 == 0, F.concat(F.floor(i / 50).cast("string"), F.lit("/LICENSE")))
        .otherwise(F.concat(F.floor(i / 50).cast("string"), F.lit("/"), i.cast("string"), F.lit(".txt")))
    )
    files = table(spark, sf_dir, "documents").select(
        F.concat_ws("/", "source", F.floor(i / 1000).cast("string"), name).alias("path"), "text"
    )
    return licenses.scan(files)


@query("op5_embedding_dedup", oracle.EMBEDDING_DEDUP)
def op5_embedding_dedup(spark, sf_dir):
    return embedding_dedup.link(table(spark, sf_dir, "embeddings"), cosine=0.93)


@query("op6_ngram_join", oracle.NGRAM_JOIN)
def op6_ngram_join(spark, sf_dir):
    return ngram_join.classes(table(spark, sf_dir, "documents"), words=4, num=85, den=100)


@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_substring_dedup", oracle.SUBSTRING_DEDUP)
def op8_substring_dedup(spark, sf_dir):
    out = substring_dedup.remove(table(spark, sf_dir, "documents"), window=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op9_topk", oracle.TOPK)
def op9_topk(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, k=5)


@query("op10_pieces")
def op10_pieces(spark, sf_dir):
    out = pieces.encode(table(spark, sf_dir, "documents"), piece_model())
    return out.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op11_sharding", oracle.SHARDING)
def op11_sharding(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents"), shards=40)


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents; a tenth of them, by a hash of the id, repeat a stretch of words to their end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    some = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w")).withColumn("n", F.size("w"))
    some = some.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    some = some.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    loop = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), times))
    new = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(loop, F.lit(1), F.col("n") - F.col("a")))
    return some.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(new, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    out = periodic_runs.find(looped(table(spark, sf_dir, "documents")), least=12)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("(1000 * longest.length) div -longest.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


@query("op13_hard_negatives", oracle.HARD_NEGATIVES)
def op13_hard_negatives(spark, sf_dir):
    """A seventh of the labels are wrong on purpose, by a rule on the id."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, label_col=label)
