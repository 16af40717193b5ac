"""A corpus in five stages: drop low quality, drop exact copies, keep one of each group of near copies, mix sources
to target weights, and encode to pieces. Every stage works on all rows its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.grace_dedup import exact_dedup
from tracklake.llm.lsa_quality import score_quality
from tracklake.llm.mixing import mix_sources
from tracklake.llm.pieces import encode_pieces, load_vocabulary
from tracklake.llm.queries import PIECE_MODEL
from tracklake.llm.set_join import jaccard_components
from tracklake.session import fresh_path, prepare


ROW = "row_key"


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with a key of all that a stage's decision depends on: id, source and text.

    Only equal rows share a key, and every operator treats them alike. Ids need not be unique or given, and a key
    is the same whenever a lost task makes it again.
    """
    source = F.sha2(F.col("source").cast("binary"), 256) if "source" in docs.columns else F.lit(None).cast("string")
    parts = (F.col("doc_id").cast("string"), source, F.col("text").cast("string"))
    return docs.withColumn(ROW, F.unhex(F.sha2(F.concat_ws("\0", *(F.coalesce(p, F.lit("")) for p in parts)), 256)))


def _marked(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows of keyed documents whose key is in `marks`, each as often as it was."""
    return docs.join(marks.select(ROW), ROW, "left_semi").drop(ROW)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = _keyed(docs)
    return _marked(docs, score_quality(docs, labels, carry=[ROW]).where("predicted = 1"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id, or all rows that share it; rows without an id if no row has one."""
    docs = _keyed(docs)
    return _marked(docs, exact_dedup(docs, carry=[ROW]).where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect (five words, similarity 0.8) the one with the smallest doc_id; unlinked ones
    stay, and so do rows without an id, which are in no group."""
    docs = _keyed(docs)
    groups = jaccard_components(docs, size=5, percent=80, carry=[ROW])
    return _marked(docs, groups.where("doc_id IS NULL OR doc_id = component_id"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes: none, one or two."""
    docs = _keyed(docs)
    # Equal rows have equal numbers of copies, so one line of them is enough and a row is not multiplied by its equals.
    chosen = mix_sources(docs, carry=[ROW]).where("copies > 0").groupBy(ROW).agg(F.max("copies").cast("int").alias("copies"))
    names = [n for n in docs.columns if n != ROW]
    copies = F.explode(F.sequence(F.lit(1), F.col("marks.copies")))
    return docs.alias("docs").join(chosen.alias("marks"), ROW).select(*(F.col(f"docs.`{n}`") for n in names), copies.alias(ROW)).drop(ROW)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row."""
    return encode_pieces(docs, load_vocabulary(PIECE_MODEL)).select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("quality", drop_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix),
    ("encode", encode),
]

ORACLE_SQL = None  # SQL cannot express the classifier and the pieces; tests/llm check the operators one by one


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written as Parquet and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
