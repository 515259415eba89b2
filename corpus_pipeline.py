"""Documents to a training mix: a stage for each step, each over all rows that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.llm import classifier, contamination, mixing, simhash, substrings
from orderflow.llm.text import table
from orderflow.llm.workers import importable
from orderflow.sources.workdir import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier calls good. Null and empty texts are judged by their shape alone."""
    importable(spark)
    return classifier.classified(docs.select(COLUMNS)).where("good").select(COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by fingerprints of 2 or fewer differing bits, the document with the smallest doc_id.

    Of rows that share this id the text of least hash stays, and of rows that are equal in both, one. Null ids are
    larger than any other.
    """
    importable(spark)
    near = simhash.near_duplicates(docs, shingle=3, max_bits=2)
    # the same keys in join and window, so that texts move once
    keys = ["no_id", "id", "text_hash"]
    named = {"no_id": F.isnull("doc_id"), "id": F.coalesce("doc_id", F.lit(0)), "text_hash": F.xxhash64("text")}
    first = near.where("first").select(named["no_id"].alias("no_id"), named["id"].alias("id"), "text_hash").distinct()
    kept = docs.withColumns(named).join(first, keys, "left_semi")
    order = Window.partitionBy(keys).orderBy("source", "lang", "n_chars")
    return kept.withColumn("nth", F.row_number().over(order)).where("nth = 1").select(COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 50-byte strings that a document with a smaller id has; n_chars is counted anew."""
    importable(spark)
    return substrings.deduplicated(docs.select(COLUMNS), length=50).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item: none with four fifths of its five-word shingles in the text."""
    importable(spark)
    return contamination.decontaminated(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: shard, slot, epoch, source, doc_id, from_word, n_words and the words themselves."""
    importable(spark)
    return mixing.with_text(docs, mixing.mix(docs))


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_items),
    ("source mixing", mixed_sources),
]

# A fitted model, connected components and drawn mixes are not for SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
