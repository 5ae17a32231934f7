"""Links in full texts: one scan, one projection for all patterns, one shuffle by document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import identifiers, links, textprep


def extract(docs: DataFrame, prepare: bool = True) -> DataFrame:
    """docs: id, content. doc_id, pattern_idx, pos, url, type: one row a hit."""
    text = textprep.prepare_fulltext(F.col("content")) if prepare else F.col("content")
    prepared = docs.select(F.col("id").alias("doc_id"), text.alias("t"))
    return prepared.select("doc_id", F.inline(links.all_links(F.col("t"))))


def keep_wanted(hits: DataFrame) -> DataFrame:
    return hits.where(links.kept(F.col("url")))


def normalise(hits: DataFrame) -> DataFrame:
    return hits.withColumn("url", links.normalised(F.col("url"), F.col("type")))


def keep_first(hits: DataFrame) -> DataFrame:
    """One row a document and link, the first in pattern and text order. A link without a normal form is one more. Rows are
    dealt by document alone, which serves a regrouping of what is left as well."""
    first = F.min(F.struct("pattern_idx", "pos", "url", "type")).alias("r")
    keyed = hits.withColumn("key", links.dedup_key(F.col("url"))).repartition("doc_id")
    return keyed.groupBy("doc_id", "key").agg(first).select("doc_id", "r.*")


def found(docs: DataFrame) -> DataFrame:
    return keep_first(normalise(keep_wanted(extract(docs))))


def regroup(hits: DataFrame) -> DataFrame:
    """id, urls: array of (url, type) in pattern and text order."""
    one = F.array_sort(F.collect_list(F.struct("pattern_idx", "pos", "url", "type")))
    return hits.groupBy(F.col("doc_id").alias("id")).agg(F.transform(one, lambda x: F.struct(x["url"].alias("url"), x["type"].alias("type"))).alias("urls"))


def with_urls(docs: DataFrame) -> DataFrame:
    """Every row of docs and its links, an empty array where there are none."""
    nothing = F.array().cast("array<struct<url:string,type:string>>")
    return docs.join(regroup(found(docs)), "id", "left").withColumn("urls", F.coalesce("urls", nothing))


def enrichment(doi: Column, url: Column, relation: str, now: str, source: str = "Software link extraction") -> list[Column]:
    """The columns of an enrichment record."""
    none = F.lit(None).cast("string")
    text = lambda **kw: F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in kw.items()])
    return [
        doi.alias("doi"), F.array(text(name=source, contributorType="Producer", nameType="Organizational")).alias("sources"),
        F.array(text(relatedIdentifier=none, relatedIdentifierType="DOI", relationType="IsDescribedBy", resourceTypeGeneral="Workflow")).alias("processResources"),
        F.lit("insert_child").alias("action"), F.lit("relatedIdentifiers").alias("field"), none.alias("originalValue"),
        text(relatedIdentifier=url, relatedIdentifierType="URL", relationType=relation).alias("enrichedValue"), *[F.lit(now).alias(k) for k in ("created", "updated", "produced")],
    ]


def enrichments(docs: DataFrame, now: str, source: str = "Software link extraction") -> DataFrame:
    """One record a link of a document whose id names a preprint."""
    mine = docs.where(identifiers.file_arxiv_id(F.col("id")).isNotNull())
    doi = identifiers.arxiv_doi(identifiers.file_arxiv_id(F.col("doc_id")))
    return found(mine).select(*enrichment(doi, F.col("url"), "References", now, source))


def observed(docs: DataFrame, now: str, source: str = "Software link extraction") -> tuple[DataFrame, Callable[[], list[tuple]]]:
    """enrichments(docs), and a function that gives metric, name, value once they have been written: the figures are taken in the
    writing pass. With a column healing_warnings in docs, the documents that have warnings are counted too."""
    read, held = Observation(), Observation()
    warned = [F.count_if(F.size("healing_warnings") > 0).alias("healing_warnings")] if "healing_warnings" in docs.columns else []
    seen = docs.observe(read, F.count("*").alias("total_papers"), *warned)
    grouped = regroup(found(seen.where(identifiers.file_arxiv_id(F.col("id")).isNotNull())))
    kinds = list(links.FULLTEXT)
    of = lambda kind: F.sum(F.size(F.filter("urls", lambda u: u["type"] == kind))).alias(kind)
    counted = grouped.observe(held, F.count("*").alias("papers_with_urls"), F.sum(F.size("urls")).alias("total_urls"), *map(of, kinds))
    each = counted.select("id", F.explode("urls").alias("u"))
    out = each.select(*enrichment(identifiers.arxiv_doi(identifiers.file_arxiv_id(F.col("id"))), F.col("u.url"), "References", now, source))

    def figures() -> list[tuple]:
        one, two = read.get, {k: v or 0 for k, v in held.get.items()}
        types = sorted(((k, two[k]) for k in kinds if two[k]), key=lambda x: -x[1])
        return [("total_papers", "", one["total_papers"]), ("papers_with_urls", "", two["papers_with_urls"]), ("total_urls", "", two["total_urls"]), *[("urls_by_type", *t) for t in types], *[("healing_warnings", "", one[k]) for k in one if k == "healing_warnings"]]

    return out, figures


def stats(docs: DataFrame) -> DataFrame:
    """metric, name, value: papers, papers with links, links, links by type (of documents whose id names a preprint)."""
    hits = found(docs.where(identifiers.file_arxiv_id(F.col("id")).isNotNull()))
    by = hits.groupBy("doc_id", "type").count()
    rows = by.select(F.lit("urls_by_type").alias("metric"), F.col("type").alias("name"), F.col("count").alias("value"))
    total = by.select(F.lit("total_urls").alias("metric"), F.lit("").alias("name"), F.col("count").alias("value"))
    each = by.groupBy("doc_id").agg(F.lit(1).cast("long").alias("value")).select(F.lit("papers_with_urls").alias("metric"), F.lit("").alias("name"), "value")
    papers = docs.select(F.lit("total_papers").alias("metric"), F.lit("").alias("name"), F.lit(1).cast("long").alias("value"))
    return rows.unionByName(total).unionByName(each).unionByName(papers).groupBy("metric", "name").agg(F.sum("value").alias("value"))
