"""Validation: which links exist. The outside is asked once a link; results go to a log before they are joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import links
from ..sources import schemas
from ..sources.files import last_of_each, read_jsonl, save_checkpoint

#: What a prober answers for links that name no repository.
INVALID = "invalid_url"


def unique_urls(records: DataFrame, *more: Column) -> DataFrame:
    """records: idx, url. Each link with its first place, the number of its records, and more aggregates. Which records a link
    has is not gathered: results go back to records by a join on url."""
    return records.where("url is not null and url != ''").groupBy("url").agg(F.min("idx").alias("first_idx"), F.count("*").alias("n"), *more)


def categorised(urls: DataFrame) -> DataFrame:
    return urls.withColumn("kind", links.category(F.col("url")))


def uncached(urls: DataFrame, cache: DataFrame) -> DataFrame:
    return urls.join(cache.select("url"), "url", "left_anti")


def check(urls: DataFrame, cache: DataFrame, probers: dict, log: str, now: str, unknown: bool = False) -> DataFrame:
    """Results for all links: cached ones, and new ones by their kind's prober (probers: kind to prober), which are appended
    to the log at once, so that a later failure asks nothing twice. Kinds without a prober get no result, unless unknown is
    set: then they are invalid with the error `no_validator`."""
    todo = categorised(uncached(urls.select("url"), cache))
    from . import fetch

    results = cache.select("url", "valid", "method", "error")
    spark = urls.sparkSession
    for prober in dict.fromkeys(probers.values()):
        kinds = [k for k, p in probers.items() if p is prober]
        if hasattr(prober, "attempt"):  # asks in lanes: a killed run is taken up where it was
            own = todo.where(F.col("kind").isin(kinds))
            got = fetch.fetched(own, f"{log}/{kinds[0]}", prober)
            told = existence(got).withColumn("method", F.lit("graphql")) if "urls" in got.columns else got
            results = results.unionByName(told.join(own.select("url"), "url", "left_semi").select("url", "valid", "method", "error"))
            continue
        batch = f"{log}/{kinds[0]}-{now.replace(':', '')}"
        save_checkpoint(prober.probe(todo.where(F.col("kind").isin(kinds))), batch, now)
        results = results.unionByName(read_jsonl(spark, batch, schemas.CHECKPOINT).select("url", "valid", "method", "error"))
    if unknown:
        rest = todo.where(~F.col("kind").isin(list(probers)))
        results = results.unionByName(rest.select("url", F.lit(False).alias("valid"), F.lit("none").alias("method"), F.lit("no_validator").alias("error")))
    return results


def latest(log: DataFrame) -> DataFrame:
    return last_of_each(log)


def applied(records: DataFrame, results: DataFrame, keep_invalid: bool = False) -> DataFrame:
    """Records whose link has a result and is valid (or all with a result), with is_valid, method, error."""
    r = results.select("url", F.col("valid").alias("is_valid"), "method", "error")
    out = records.where("url is not null and url != ''").join(r, "url")
    return out if keep_invalid else out.where("is_valid")


def stats(results: DataFrame) -> DataFrame:
    """metric, name, value: totals, valid and invalid by kind, errors by kind (null: unknown)."""
    kind = links.category(F.col("url"))
    base = results.select(kind.alias("kind"), "valid", F.coalesce("error", F.lit("unknown")).alias("error"))
    state = F.when(F.col("valid"), "valid").otherwise("invalid")
    by = base.groupBy("kind", state.alias("state"), F.when(~F.col("valid"), F.col("error")).alias("error")).count()
    part = lambda metric, name, where="true": by.where(where).select(F.lit(metric).alias("metric"), name.alias("name"), F.col("count").alias("value"))
    rows = part("total", F.lit("")).unionByName(part("state", F.col("state"))).unionByName(part("kind", F.concat_ws(":", "kind", "state"))).unionByName(part("error", F.concat_ws(":", "kind", "error"), "state = 'invalid'"))
    return rows.groupBy("metric", "name").agg(F.sum("value").alias("value"))


def existence(responses: DataFrame) -> DataFrame:
    """urls (in alias order), response (JSON): url, valid, error. Without an answer: request_failed; without data: api_error."""
    r = responses.select("urls", "response", F.from_json("response", _struct(schemas.GRAPHQL)).alias("r"))
    each = r.select("response", "r", F.posexplode("urls").alias("i", "url"))
    alias = F.concat(F.lit("repo"), "i")
    node = F.try_element_at("r.data", alias)
    own = F.get(F.filter("r.errors", lambda e: F.get(e["path"], 0) == alias), F.size(F.filter("r.errors", lambda e: F.get(e["path"], 0) == alias)) - 1)
    refused = F.col("r.data").isNull() & F.col("r.message").isNotNull()
    failed = F.when(F.col("response").isNull(), "request_failed").when(refused, F.when(F.col("r.message") == INVALID, INVALID).otherwise("api_error"))
    error = F.when(failed.isNotNull(), failed).when(node.isNull(), F.when(own.isNull(), F.lit("not_found")).otherwise(F.coalesce(own["type"], F.lit("error"))))
    return each.select("url", error.isNull().alias("valid"), error.alias("error"))


def metadata(responses: DataFrame, readme_limit: int = 1_000_000) -> DataFrame:
    """urls, response: url, description, readme_content (first variant with text), contributors, fetch_error."""
    r = responses.select("urls", "response", F.from_json("response", _struct(schemas.GRAPHQL)).alias("r"))
    each = r.select(F.posexplode("urls").alias("i", "url"), F.col("response").isNull().alias("failed"), "r")
    n = each.select("url", "failed", F.col("r.message").alias("message"), F.try_element_at("r.data", F.concat(F.lit("repo"), "i")).alias("n"))
    readme = F.coalesce(*[F.nullif(F.col(f"n.{k}.text"), F.lit("")) for k in ("readme_md", "readme_rst", "readme_txt", "readme_plain")])
    people = F.coalesce(F.filter("n.mentionableUsers.nodes", lambda x: x.isNotNull()), F.array().cast("array<struct<login:string,name:string,email:string>>"))
    return n.select("url", F.col("n.description").alias("description"), F.substring(readme, 1, readme_limit).alias("readme_content"), F.when(F.col("n").isNotNull(), people).alias("contributors"), F.when(F.col("failed"), "request_failed").when(F.col("message") == INVALID, INVALID).when(F.col("n").isNull(), "not_found").alias("fetch_error"))


def _struct(schema: str) -> str:
    return schema
