"""Parquet and JSON lines in and out, with the checkpoint and metadata logs."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas

CONTENT_COLUMNS = ["content", "text", "markdown", "md", "body"]


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, if it is read in few parts: a file with one row group is one task with rows, however it is split.
    Larger inputs stay as they are and cost no shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < 4 * cores else df


def read_fulltext(spark: SparkSession, path: str, id_column: str = "relative_path", text_column: str = "content") -> DataFrame:
    """id, content; other columns are not read."""
    return spread(spark.read.parquet(path).select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("content")))


def content_column(df: DataFrame) -> str:
    for name in CONTENT_COLUMNS:
        if name in df.columns:
            return name
    raise ValueError(f"none of {CONTENT_COLUMNS} is a column")


def row_count(df: DataFrame) -> int:
    """Rows; of a parquet table, from the footers."""
    return df.count()


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, gzipped if the name says so; malformed and blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, schemas.RECORD)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """value, and where it stands: file, start of the block that was read, place in the block. Compressed files are one block."""
    raw = spark.read.text(path)
    place = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    return raw.select("value", place.alias("place"))


def numbered_lines(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """idx, value: lines that are not blank, numbered densely from 0 in the order of file names and lines. Lines are counted by
    block first, so that a line's number is its block's first number and its rank in the block; the lines of a block are
    brought together for the rank, since blank ones leave gaps."""
    lines = _lines(spark, path).where(F.trim("value") != "")
    block = ["place.path", "place.start"]
    counts = lines.groupBy(*block).agg(F.count("*").alias("n")).collect()  # one row a block
    first, at = [], 0
    for r in sorted(counts, key=lambda r: (r.path, r.start)):
        first.append((r.path, r.start, at))
        at += r.n
    starts = spark.createDataFrame(first, "path string, start bigint, first bigint")
    joined = lines.select("value", "place.*").join(F.broadcast(starts), ["path", "start"])
    # Places in a block are numbered within its partition: blank lines leave gaps, which the rank in the block closes.
    w = Window.partitionBy("path", "start").orderBy("line")
    ranked = joined.withColumn("idx", F.col("first") + F.row_number().over(w) - 1)
    if strict:
        bad = F.from_json("value", "struct<__bad:string>", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})["__bad"]
        message = F.concat(F.lit("not JSON: "), F.substring("value", 1, 200))
        ranked = ranked.withColumn("value", F.when(bad.isNotNull(), F.raise_error(message)).otherwise(F.col("value")))
    return ranked.select("idx", "value")


def parsed(lines: DataFrame, schema: str) -> DataFrame:
    """idx and the fields of idx, value."""
    return lines.select("idx", F.from_json("value", T._parse_datatype_string(f"struct<{_colons(schema)}>")).alias("r")).select("idx", "r.*")


def with_order(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """JSON lines with `idx`: rules that depend on record order need it. A line that is no JSON is a row of nulls, or an error
    if strict."""
    return parsed(numbered_lines(spark, path, strict), schema)


def _colons(schema: str) -> str:
    """A table schema as the fields of a struct."""
    return T._parse_datatype_string(schema).simpleString()[len("struct<") : -1]


def to_line(record: Column) -> Column:
    """One JSON object; nulls are written, as in the input of the next step."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists", line: Column | None = None) -> None:
    df.select((to_line(F.struct(*df.columns)) if line is None else line).alias("value")).write.mode(mode).text(path)


def save_checkpoint(results: DataFrame, path: str, now: str) -> None:
    """Appends url, valid, method, error with one time for the batch."""
    results.select("url", "valid", "method", "error", F.lit(now).alias("checked_at")).write.mode("append").json(path)


def save_metadata(repos: DataFrame, path: str) -> None:
    """Appends url, description, readme_content, contributors, fetch_error to the log of repositories."""
    repos.select("url", "description", "readme_content", "contributors", "fetch_error").write.mode("append").json(path)


def last_of_each(df: DataFrame, key: str = "url", order: str = "idx") -> DataFrame:
    """The last row of each key in append order. Aggregates before the shuffle."""
    cols = [c for c in df.columns if c not in (key, order)]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*cols), order).alias("r")).select(key, "r.*")


def default_output(path: str, step: str) -> str:
    """Where a step writes if it is not told."""
    suffix = {"extract": "_enrichments.jsonl", "validate": "_validated.jsonl", "validate-promote": "_validated_promoted.jsonl", "heal": "_healed.parquet", "promote": "_promoted.jsonl"}[step]
    return os.path.splitext(path)[0] + suffix
