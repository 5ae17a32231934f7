"""Healing of a table of texts; all other columns stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.healing import healed


def heal_table(df: DataFrame, column: str = "content") -> DataFrame:
    """column repaired, and `healing_warnings`; empty texts become '' without a warning."""
    empty = F.coalesce(F.col(column), F.lit("")) == ""
    out = healed(df.withColumn("__empty", empty), column, "healing_warnings")
    return out.withColumn("healing_warnings", F.when(F.col("__empty"), F.array().cast("array<string>")).otherwise(F.col("healing_warnings"))).drop("__empty")


def heal_stats(df: DataFrame) -> DataFrame:
    """total, healed, warnings: rows, rows without a warning, rows with one."""
    warned = F.size("healing_warnings") > 0
    return df.agg(F.count("*").alias("total"), F.count_if(~warned).alias("healed"), F.count_if(warned).alias("warnings"))
