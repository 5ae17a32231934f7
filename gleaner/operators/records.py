"""Links in the descriptions of bibliographic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import links, textprep
from .fulltext import enrichment


def hits(text: Column, low: Column) -> Column:
    """array of (pattern_idx, pos, link, group, type) in a prepared text, any case; low is its lower case. The group is read
    from the link as found."""
    nothing = F.array().cast("array<struct<pattern_idx:int,pos:int,link:string,group:string,type:string>>")

    def group(i: int, name: str, pattern: str) -> Column:
        found = F.when(F.contains(low, F.lit(links.LITERAL[name])), F.regexp_extract_all(text, F.lit(f"(?i){pattern}"), F.lit(0)))
        inner = lambda x: F.regexp_extract(x, f"(?i){pattern}", 1)
        hit = lambda x, pos: F.struct(F.lit(i).alias("pattern_idx"), pos.alias("pos"), x.alias("link"), inner(x).alias("group"), F.lit(name).alias("type"))
        return F.coalesce(F.transform(found, hit), nothing)

    return F.flatten(F.array(*[group(i, *x) for i, x in enumerate(links.RECORD.items())]))


def extract(texts: DataFrame, unescape: bool = True) -> DataFrame:
    """texts: rec_id, part, text. One row a canonical link: the first of each base key in each text."""
    t = texts.select("rec_id", "part", textprep.prepare_record(F.col("text"), unescape).alias("t"))
    each = t.select("rec_id", "part", "t", F.lower("t").alias("low")).select("rec_id", "part", F.inline(hits(F.col("t"), F.col("low"))))
    named = each.withColumn("url", links.canonical(F.col("type"), F.col("link"), F.col("group"))).where("url is not null and url != ''").withColumn("base", links.base_key(F.col("url")))
    first = F.min(F.struct("pattern_idx", "pos", "type", "url")).alias("r")
    return named.groupBy("rec_id", "part", "base").agg(first).select("rec_id", "part", "r.*", "base")


def not_known(found: DataFrame, known: DataFrame) -> DataFrame:
    """Without links whose base key a record's identifiers (rec_id, identifier, kind) have; null identifiers match nothing."""
    have = known.where("kind = 'URL' and identifier is not null").select("rec_id", links.base_key(F.col("identifier")).alias("base"))
    return found.join(have, ["rec_id", "base"], "left_anti")


def from_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Descriptions (rec_id, part, text) of type Abstract or Other, and identifiers, of records with an id."""
    doi = F.coalesce(F.nullif("id", F.lit("")), F.nullif("attributes.doi", F.lit(""))).alias("rec_id")
    mine = records.select(doi, "attributes").where("rec_id is not null")
    parts = mine.select("rec_id", F.posexplode("attributes.descriptions").alias("part", "d")).where("d.descriptionType in ('Abstract', 'Other') and d.description != ''")
    known = mine.select("rec_id", F.explode("attributes.relatedIdentifiers").alias("i")).select("rec_id", F.col("i.relatedIdentifier").alias("identifier"), F.col("i.relatedIdentifierType").alias("kind"))
    return parts.select("rec_id", "part", F.col("d.description").alias("text")), known


def unique_links(texts: DataFrame, known: DataFrame, unescape: bool = True) -> DataFrame:
    """Each new link of a record once, from its first description."""
    new = not_known(extract(texts, unescape), known)
    first = F.min(F.struct("part", "pattern_idx", "pos", "type", "base")).alias("r")
    return new.groupBy("rec_id", "url").agg(first).select("rec_id", "r.part", "r.pattern_idx", "r.pos", "r.type", "url", "r.base")


def enrichments(records: DataFrame, now: str, source: str = "Software link extraction") -> DataFrame:
    texts, known = from_records(records)
    return unique_links(texts, known).select(*enrichment(F.col("rec_id"), F.col("url"), "IsSupplementedBy", now, source))
