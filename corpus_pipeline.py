"""From raw documents to a training mix: quality, near-duplicates, decontamination, secrets, mixing.

Each stage takes what the one before it kept, written as Parquet, and returns the columns of `documents`; the last adds `copies`.
Other columns are left out, whatever their names. An empty table gives an empty result. Null ids are rows like any other; a null
text is an empty one to every decision and stays null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bidloom.llm import decontaminate, mixing, quality, secrets, simhash
from bidloom.llm.queries import ARROW_ROWS, table
from bidloom.session import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def _by_row(documents: DataFrame, decisions: DataFrame, how: str) -> DataFrame:
    """Join on the id (null counts as equal) and the hash of the text."""
    return documents.alias("d").join(
        decisions.alias("v"),
        F.col("d.doc_id").eqNullSafe(F.col("v.doc_id")) & (F.xxhash64("d.text") == F.col("v.text_hash")), how)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null and blank texts are judged like others; equal rows share a decision."""
    return quality.keep_good(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id, once.

    Only documents that go, or whose row is repeated, are joined to the texts. Of rows with equal id and text the one with the
    smallest (lang, source, n_chars) stays, null first. Blank texts and null texts are one group."""
    _small_batches(spark)
    groups = simhash.near_duplicates(docs)
    special = materialise(
        groups.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"), F.max("representative").alias("stays"))
        .filter("n > 1 OR NOT stays"), "copies")
    judged = _by_row(docs.select(*COLUMNS), special, "left").select("d.*", "v.n", "v.stays")
    once = judged.filter("n IS NULL").select(*COLUMNS)
    repeated = judged.filter("n > 1 AND stays").groupBy("doc_id", F.xxhash64("text").alias("h")).agg(
        F.min(F.struct("lang", "source", "n_chars", "text")).alias("row"))
    return once.unionByName(repeated.select("doc_id", *[f"row.{c}" for c in COLUMNS[1:]]))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in benchmark windows go. Texts without words stay; equal rows share a decision."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), slop=None)
    bad = materialise(found.filter("contaminated").select("doc_id", "text_hash"), "contaminated")
    return _by_row(docs.select(*COLUMNS), bad, "left_anti")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by a mark, and `n_chars` follows."""
    _small_batches(spark)
    clean = secrets.redact(docs.select(*COLUMNS))
    return clean.select("doc_id", "text", "lang", "source", F.coalesce(F.length("text").cast("long"), F.col("n_chars")).alias("n_chars"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of copies of each. A null source is a source of its own; repeated rows
    are taken one by one."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scan", secret_stage),
    ("mixing", mixing_stage),
]

#: SQL has neither XXH64 nor the learnt ranking; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
