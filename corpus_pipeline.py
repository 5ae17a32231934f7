"""A training-corpus pipeline of five of the operators in gleaner.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it to the shared folder and reads it again
as the next stage's docs. All but the last keep the columns of documents. Null, empty and repeated rows are treated as the
operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import linededup, mixing, neardup, packing, toxicity
from gleaner.llm.common import materialise, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches their language's threshold go. The model learns from the rows of `labels` whose
    document is in docs."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_scores(docs, model, "__score")
    return scored.where(F.col("__score") < toxicity.threshold(model)).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go; a document that had words and has none left goes with them."""
    words = lambda c: F.coalesce(F.col(c).rlike(r"\S"), F.lit(False))
    clean = linededup.without_repeats(docs)
    kept = clean.where(words("text") | (F.col("n_removed") == 0))
    changed = F.col("n_removed") > 0
    return kept.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.length_buckets(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("near duplicates", without_near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

#: Training a classifier and alignment can't be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
