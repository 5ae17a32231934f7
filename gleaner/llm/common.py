"""What the operators share: tables, the shared folder, row keys and dense numbering."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: monotonically_increasing_id() holds the partition above this bit and the row's place in it below.
PLACE_BITS = 33


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see; in local runs without one, a new temporary folder."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or getattr(spark.sparkContext, "_gleaner_shared", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = spark.sparkContext._gleaner_shared = "file://" + tempfile.mkdtemp(prefix="gleaner-")
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes df as a table in the shared folder and returns that table: cuts lineage, survives lost executors, and
    fixes what a recomputation could number differently."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Equal for rows with equal id and text only, null-safe, never null."""
    return F.md5(F.concat_ws("\x00", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.when(F.col(text).isNull(), F.lit("n")).otherwise(F.lit("t")), F.col(text)))


def numbered(df: DataFrame, order: list[Column], label: str) -> tuple[DataFrame, int]:
    """df (narrow columns; written once to the shared folder) with a dense bigint column `idx` in the given order, and
    the number of rows. Only one count per range partition goes to the driver."""
    spark = df.sparkSession
    n = partitions(spark)
    place = F.col("__place")
    placed = materialise(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id()), label)
    part = F.shiftright(place, PLACE_BITS)
    counts = sorted(placed.groupBy(part.alias("p")).count().collect())  # one row per partition
    first, total = [], 0
    for p, c in counts:
        first.append((int(p), total))
        total += c
    starts = spark.createDataFrame(first, T.StructType([T.StructField("__p", T.LongType()), T.StructField("__first", T.LongType())]))
    idx = F.col("__first") + place.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    joined = placed.withColumn("__p", part).join(F.broadcast(starts), "__p")
    return joined.withColumn("idx", idx).drop("__place", "__p", "__first"), total
