"""Promotion of links when independent signals agree.

Inputs: enrichments (idx, doi, url, relation, is_valid), papers (doi, title, authors, arxiv_id; one a DOI), repositories
(url, description, readme_content, contributors, fetch_error; one a link). `idx` is the record order, which decides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import arxiv_content, arxiv_match_in, paper_doi
from ..functions.links import repo_parts
from ..functions.similarity import name_match
from . import authors

THRESHOLD, CHUNK = 2, 1000
c = F.col


def signals(arxiv: Column, name: Column, author: Column) -> Column:
    """The names of the signals that hold; arxiv and name are structs, author a boolean."""
    return F.array_compact(F.array(F.when(arxiv["matched"], F.concat(F.lit("arxiv_id_in_"), arxiv["location"])), F.when(name["matched"], F.lit("name_similarity")), F.when(author, F.lit("author_match"))))


def voted(found: Column, threshold: int = THRESHOLD) -> Column:
    return F.size(found) >= threshold


def evidence(arxiv: Column, name: Column, matched: Column, matches: Column, skipped: Column) -> Column:
    return F.struct(
        arxiv["found_id"].alias("arxiv_id_found"), arxiv["location"].alias("arxiv_id_location"), arxiv["skip_reason"].alias("arxiv_skipped"), name["score"].alias("name_similarity_score"),
        name["containment"].alias("name_containment_score"), name["overlap"].alias("name_token_overlap_score"), name["fuzzy"].alias("name_fuzzy_score"), name["skip_reason"].alias("name_skipped"),
        F.when(matched, matches).alias("author_matches"), F.when(~matched, skipped).alias("author_skipped"),
    )


def eligible(records: DataFrame, papers: DataFrame) -> DataFrame:
    """Valid records with a repository link and a paper; adds doi_key and repo."""
    owner, repo = repo_parts(F.col("url"))
    keyed = records.withColumn("doi_key", paper_doi(F.col("doi"))).withColumn("repo", repo)
    return keyed.where(F.col("is_valid") & owner.isNotNull() & F.col("repo").isNotNull()).join(papers.select(paper_doi(F.col("doi")).alias("doi_key")).distinct(), "doi_key", "left_semi")


def fast(items: DataFrame) -> DataFrame:
    """Adds the two signals that need no model."""
    _, repo = repo_parts(F.col("url"))
    a = arxiv_match_in(F.col("arxiv_id"), F.col("content"))
    return items.withColumn("arxiv", a).withColumn("name", name_match(F.coalesce(repo, F.lit("")), F.col("title")))


def needs_author(arxiv: Column, name: Column, threshold: int = THRESHOLD) -> Column:
    """Exactly one signal short: the model decides."""
    return arxiv["matched"].cast("int") + name["matched"].cast("int") == threshold - 1


def _papers(papers: DataFrame) -> DataFrame:
    return papers.select(paper_doi(F.col("doi")).alias("doi_key"), "title", "authors", "arxiv_id", F.lit(True).alias("has_paper"))


def _repos(repos: DataFrame) -> DataFrame:
    """What promotion needs of each repository. Texts are searched here, once a repository, and go no further."""
    return repos.select("url", arxiv_content(F.col("readme_content"), F.col("description")).alias("content"), "contributors", "fetch_error", F.lit(True).alias("has_data"))


def _judged(items: DataFrame, factory: Callable | None, threshold: int, short_circuit: bool) -> DataFrame:
    """Adds signals, promoted and evidence to rows with paper and repository."""
    # The exchange stands above the costly comparison, so that the branches below share it; a filter would be pushed under it
    # and compare again, therefore pairs that need no model lose their contributors instead.
    f = fast(items).repartition("url", "doi_key")
    ask = needs_author(c("arxiv"), c("name"), threshold) if short_circuit else F.lit(True)
    asked = f.select("url", c("doi_key").alias("doi"), F.when(ask, c("contributors")).alias("contributors"), "authors")
    m = authors.matches(asked, factory, first_only=not short_circuit).withColumnRenamed("doi", "doi_key")
    j = f.join(m, ["url", "doi_key"], "left").withColumn("author", F.coalesce("matched", F.lit(False))).withColumn("skip_reason", F.when(ask, c("skip_reason")))
    s = signals(F.col("arxiv"), F.col("name"), F.col("author"))
    return j.withColumn("signals", s).withColumn("evidence", evidence(F.col("arxiv"), F.col("name"), F.col("author"), F.col("matches"), F.col("skip_reason"))).withColumn("ok", voted(s, threshold))


def per_url(records: DataFrame, papers: DataFrame, repos: DataFrame, factory: Callable | None = None, threshold: int = THRESHOLD, relation: str = "isSupplementedBy") -> DataFrame:
    """One verdict a link: its first eligible record decides for all its records. Links without one stay as they are.
    Adds promoted (null: not judged), original_relation, signals, evidence."""
    first = eligible(records, papers).groupBy("url").agg(F.min_by("doi_key", "idx").alias("doi_key"))
    items = first.join(_papers(papers), "doi_key").join(_repos(repos), "url", "left")
    known = items.where("has_data and fetch_error is null")
    judged = _judged(known, factory, threshold, short_circuit=False).select("url", "ok", "signals", "evidence")
    verdict = first.select("url").join(judged, "url", "left").select("url", F.coalesce("ok", F.lit(False)).alias("promoted"), F.coalesce("signals", F.array().cast("array<string>")).alias("signals"), "evidence")
    out = records.join(verdict, "url", "left").withColumn("original_relation", F.when(F.col("promoted").isNotNull(), F.coalesce("relation", F.lit("References"))))
    return out.withColumn("relation", F.when(F.col("promoted"), F.lit(relation)).otherwise(F.col("relation")))


def per_pair(records: DataFrame, papers: DataFrame, repos: DataFrame, factory: Callable | None = None, threshold: int = THRESHOLD, chunk: int = CHUNK, relation: str = "IsSupplementedBy") -> DataFrame:
    """A verdict for each link and DOI in record order; the first promotion of a link wins. A link promoted in an earlier
    chunk of records outranks missing data; one promoted in the same chunk does not.
    Adds promoted (null: no code-host link), skip_reason, original_relation, signals, evidence. idx counts from 0."""
    r = records.withColumn("doi_key", paper_doi(F.col("doi"))).withColumn("chunk", F.floor(F.col("idx") / chunk))
    host = F.contains(F.lower("url"), F.lit("github.com"))
    pairs = r.where(host).select("url", "doi_key").distinct()
    items = pairs.join(_papers(papers), "doi_key", "left").join(_repos(repos), "url", "left")
    judged = _judged(items.where("has_paper and has_data and fetch_error is null"), factory, threshold, short_circuit=True).select("url", "doi_key", "ok", "signals", "evidence")
    state = items.select("url", "doi_key", "has_paper", F.when(F.col("has_data").isNull(), "no_promotion_data").otherwise(F.col("fetch_error")).alias("missing")).join(judged, ["url", "doi_key"], "left")
    # The first row that the vote carries is the one that promotes its link: an aggregate, so that no task holds all rows of a link.
    winner = r.join(judged.where("ok").select("url", "doi_key"), ["url", "doi_key"]).groupBy("url").agg(F.min("idx").alias("won"))
    each = r.join(state, ["url", "doi_key"], "left").join(winner, "url", "left")
    ok = F.coalesce("ok", F.lit(False))
    before, earlier = F.coalesce(c("idx") > c("won"), F.lit(False)), F.coalesce(c("chunk") > F.floor(c("won") / chunk), F.lit(False))
    skip = F.when(host, F.when(earlier, "url_already_promoted").when(F.col("has_paper").isNull(), "no_paper_record").when(F.col("missing").isNotNull(), F.col("missing")).when(before, "url_already_promoted"))
    out = each.withColumn("skip_reason", skip).withColumn("promoted", F.when(host, ok & skip.isNull()))
    fine = host & F.col("skip_reason").isNull()
    out = out.withColumn("original_relation", F.when(fine, F.coalesce("relation", F.lit("References")))).withColumn("signals", F.when(fine, F.col("signals"))).withColumn("evidence", F.when(fine, F.col("evidence")))
    return out.withColumn("relation", F.when(F.col("promoted"), F.lit(relation)).otherwise(F.col("relation"))).drop("doi_key", "chunk", "has_paper", "missing", "ok", "won")
