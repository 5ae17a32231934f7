"""Fetching what a log lacks, once a link.

The log is a folder: `answers/<run>` are results of finished runs, `plans/<run>` the links of each run, `journals/<run>` what the lanes
of a run that has not finished have been told. A run is: links that the log does not have (anti-join), dealt to lanes and
written as the plan; asked, with a journal; written as answers by one Spark job, whose `_SUCCESS` file is the end of the run.
A killed run is taken up by the next call: its plan stays, lanes read their journals and ask for the rest. So a link is asked
again only if its call was open when the run was killed.

Nulls and empty links are never asked. One caller at a time writes a log.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import lanes
from . import validate


def _fs(log: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(log)


def _folders(log: str, kind: str) -> list[str]:
    from pyarrow import fs

    system, path = _fs(log)
    found = system.get_file_info(fs.FileSelector(f"{path}/{kind}", allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory)


def _ended(log: str, kind: str, run: str) -> bool:
    system, path = _fs(log)
    return system.get_file_info(f"{path}/{kind}/{run}/_SUCCESS").is_file


def runs(log: str) -> tuple[list[str], list[str]]:
    """Finished runs, and planned ones that have not finished. A plan that was not written to its end is none."""
    done = [r for r in _folders(log, "answers") if _ended(log, "answers", r)]
    return done, [r for r in _folders(log, "plans") if r not in done and _ended(log, "plans", r)]


def answers(spark: SparkSession, log: str, schema: str) -> DataFrame:
    """All results of finished runs."""
    done, _ = runs(log)
    return spark.read.schema(schema).json([f"{log}/answers/{r}" for r in done]) if done else spark.createDataFrame([], schema)


def links_of(found: DataFrame) -> DataFrame:
    return found.select(F.explode("urls").alias("url")) if "urls" in found.columns else found.select("url")


def finish(spark: SparkSession, log: str, run: str, prober) -> None:
    plan = spark.read.parquet(f"{log}/plans/{run}")
    lanes.asked(plan, prober, f"{log}/journals/{run}").write.mode("overwrite").json(f"{log}/answers/{run}")
    system, path = _fs(log)
    if system.get_file_info(f"{path}/journals/{run}").type.name == "Directory":
        system.delete_dir(f"{path}/journals/{run}")


def fetched(urls: DataFrame, log: str, prober) -> DataFrame:
    """Results for all links that were ever asked for in this log, those of urls among them. urls: url, and what the prober wants."""
    spark = urls.sparkSession
    for run in runs(log)[1]:
        finish(spark, log, run, prober)
    asked = links_of(answers(spark, log, prober.schema)).distinct()
    todo = urls.where("url is not null and url != ''").dropDuplicates(["url"]).join(asked, "url", "left_anti")
    run = uuid.uuid4().hex
    prober.plan(todo).write.parquet(f"{log}/plans/{run}")
    if not spark.read.parquet(f"{log}/plans/{run}").isEmpty():
        finish(spark, log, run, prober)
    return answers(spark, log, prober.schema)


def missing_metadata(urls: DataFrame, known: DataFrame, log: str, prober) -> DataFrame:
    """url, description, readme_content, contributors, fetch_error of all links: known ones as they are, the others fetched
    (prober: of metadata, in batches)."""
    columns = ["url", "description", "readme_content", "contributors", "fetch_error"]
    new = urls.select("url").join(known.select("url"), "url", "left_anti")
    got = validate.metadata(fetched(new, log, prober)).select(*columns)
    return known.select(*columns).unionByName(got.join(known.select("url"), "url", "left_anti"))


def as_validation(metadata: DataFrame) -> DataFrame:
    """url, valid, method, error: a repository exists if its metadata came without an error."""
    valid = F.col("fetch_error").isNull()
    return metadata.select("url", valid.alias("valid"), F.lit("graphql_promotion").alias("method"), F.col("fetch_error").alias("error"))
