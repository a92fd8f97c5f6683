"""A corpus pipeline of five stages over the documents; each works on what the one before kept.

1. language: texts without a language go.
2. near_duplicates: of documents alike in five-word shingles (Jaccard 0.8 or more) the first stays.
3. substrings: passages of 50 words or more that stand in an earlier document are cut out.
4. mixing: the rows become one stream in which the sources keep their target weights.
5. pieces: every text as SentencePiece ids, with the text decoded from them and its place in the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamiz.llm import language, mixing, ngram_join, pieces, substring_dedup
from tamiz.llm.queries import piece_model
from tamiz.runtime import scratch_path, small_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return language.accept(docs.select(COLUMNS), piece_model())


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return ngram_join.one_of_each(docs, words=5, num=4, den=5)


def cut_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Other white space stays as it was; a document of which nothing is left goes."""
    small_batches(spark)
    out = substring_dedup.remove(docs, window=50, carry=("lang", "source", "n_chars"), spacing="kept")
    changed = F.col("n_removed") > 0
    return out.where(~changed | (F.col("n_removed") < F.col("n_words"))).select(
        "doc_id", "text", "lang", "source", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_order(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A table that says the places (``position``) keeps them."""
    small_batches(spark)
    place = ("position",) if "position" in docs.columns else ()
    out = pieces.encode(docs, piece_model(), carry=place)
    return out.select(*place, "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", cut_substrings),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

#: Language scores and a library's ids are nothing that SQL computes; the tests hold each stage against plain Python.
ORACLE_SQL = None


def placed(spark: SparkSession, path: str) -> DataFrame:
    """The table written to ``path`` with ``position``, the place of each row from 0 on, in the order it was written.

    Parts follow one another by number; Spark reads them in any order.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file_"), F.col("_metadata.row_index").alias("row_"))
    part = F.regexp_extract("file_", r"part-(\d+)", 1).cast("long")
    before = Window.orderBy(part, "file_").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file_").agg(F.count("*").alias("size"))
    files = files.select("file_", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before_"))
    return rows.join(files, "file_").withColumn("position", F.col("before_") + F.col("row_")).drop("file_", "row_", "before_")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows with their ``position`` in the stream; what each of the others keeps is
    written as a table and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    docs = placed(spark, path)
    return STAGES[-1][1](spark, docs, sf_dir)
