"""Mixing sources to target weights by Poisson replication.

A source's rate is its target share of all code points over its own share. Each document draws its number of copies from
a Poisson distribution with that mean, by inverting the distribution function at a hash of its id: the draw depends on
nothing but the id and the seed. The copies are then put in the order of a hash, over all data.

Nulls: a null source counts as the source ''; a null text is empty; a null doc_id draws by its text. A source without a
code point keeps rate 1. Rows that repeat a doc_id draw alike;
their copies have one mix_key and follow each other by the hash of their text. Further columns are kept, but for earlier mix_rate, mix_copy
and mix_key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, materialise

#: A larger rate is the sum of several draws with this mean at most, so that exp(-mean) stays far from 0.
MEAN = 32.0


def _source() -> Column:
    return F.coalesce(F.col("source"), F.lit(""))


def rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5) -> DataFrame:
    """__source, rate, cdf (of one draw), draws. Without weights, a source's target weight is its size to the power of
    the temperature; with weights, a source that they don't name has weight 0. One row a source."""
    sizes = materialise(docs.groupBy(_source().alias("__source")).agg(F.sum(F.char_length(F.coalesce("text", F.lit("")))).alias("size")), "source-sizes")
    if weights is None:
        power = F.sqrt(F.col("size")) if temperature == 0.5 else F.pow(F.col("size").cast("double"), F.lit(float(temperature)))
        given = sizes.withColumn("weight", power)
    else:
        named = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()] or [("", 0.0)], "__source string, weight double")
        given = sizes.join(F.broadcast(named), "__source", "left").fillna(0.0, ["weight"])
    given = given.withColumn("weight", F.when(F.col("size") > 0, F.col("weight")).otherwise(0.0))
    total, weight = given.agg(F.sum("size"), F.sum("weight")).first()
    rate = F.when((F.col("size") > 0) & F.lit((weight or 0) > 0), F.col("weight") / F.lit(weight or 1.0) * F.lit(float(total or 0)) / F.col("size")).otherwise(1.0)
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / MEAN).cast("int"))
    mean = F.col("rate") / F.col("draws")
    top = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))
    step = lambda a, k: F.struct((a["p"] * mean / k).alias("p"), F.array_append(a["c"], F.element_at(a["c"], -1) + a["p"] * mean / k).alias("c"))
    return given.withColumn("rate", rate).withColumn("draws", draws).withColumn("cdf", F.aggregate(F.sequence(F.lit(1), top), start, step, lambda a: a["c"])).select("__source", "rate", "draws", "cdf")


def uniform(*parts: Column) -> Column:
    """In (0, 1), from 52 bits of a hash."""
    return (F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4503599627370496.0)


def poisson_mix(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, seed: int = 7) -> DataFrame:
    """The rows of docs, each as often as drawn, with mix_rate, mix_copy (from 1) and mix_key, sorted by mix_key."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce("text", F.lit("")))))
    docs = docs.drop("mix_rate", "mix_copy", "mix_key")
    table = rates(docs, weights, temperature).toDF("__source", "__rate", "__draws", "__cdf")
    by = docs.withColumn("__source", _source()).withColumn("__key", key).join(table, "__source")
    u = lambda j: uniform(F.lit(f"draw {seed}"), j.cast("string"), F.col("__key"))
    one = lambda j: let(u(j), lambda x: F.size(F.filter("__cdf", lambda c: c < x)))
    count = F.aggregate(F.sequence(F.lit(1), F.col("__draws")), F.lit(0), lambda a, j: a + one(j))
    copies = by.withColumn("__n", count).where("__n > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    mixed = copies.withColumn("mix_key", F.md5(F.concat_ws("|", F.lit(f"order {seed}"), F.col("mix_copy").cast("string"), F.col("__key"))))
    return mixed.withColumn("mix_rate", F.round("__rate", 6)).select(*docs.columns, "mix_rate", F.col("mix_copy").cast("long").alias("mix_copy"), "mix_key").orderBy("mix_key", F.md5(F.coalesce("text", F.lit(""))))


def oracle(docs: str = "documents", columns: str = "doc_id, text, lang, source, n_chars", extra: str = ", round(rate, 6) AS mix_rate, mix_copy, mix_key") -> str:
    """DuckDB SQL for poisson_mix() with its defaults, rates up to MEAN."""
    return f"""
WITH RECURSIVE sizes AS (SELECT coalesce(source, '') AS s, sum(length(coalesce(text, ''))) AS size FROM {docs} GROUP BY 1),
w AS (SELECT s, size, CASE WHEN size > 0 THEN sqrt(size) ELSE 0 END AS weight FROM sizes),
r AS (SELECT s, CASE WHEN size > 0 THEN weight / (SELECT sum(weight) FROM w) * (SELECT sum(size) FROM w)::DOUBLE / size ELSE 1.0 END AS rate FROM w),
p AS (SELECT s, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM r
      UNION ALL SELECT s, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM p WHERE k < ceil(rate + 12 * sqrt(rate) + 40)),
cdf AS (SELECT s, any_value(rate) AS rate, list(c ORDER BY k) AS cdf FROM p GROUP BY s),
d AS (SELECT *, coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, ''))) AS key FROM {docs}),
u AS (SELECT d.*, rate, cdf, (('0x' || substr(md5('draw 7|1|' || key), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN cdf ON coalesce(d.source, '') = cdf.s),
n AS (SELECT *, len(list_filter(cdf, lambda x: x < u)) AS n FROM u),
e AS (SELECT *, unnest(range(1, n + 1)) AS mix_copy FROM n WHERE n > 0),
f AS (SELECT *, md5('order 7|' || mix_copy::VARCHAR || '|' || key) AS mix_key FROM e)
SELECT {columns}{extra} FROM f
"""
