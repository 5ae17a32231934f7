"""DOIs and preprint identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEW_ID, OLD_ID = r"\d{4}\.\d{4,5}", r"[a-z-]+/\d{7}"


def record_doi(c: Column) -> Column:
    """Lower case, trimmed, without https://doi.org/, then http://doi.org/, then doi: in front."""
    c = F.regexp_replace(F.lower(c), r"(?U)^\s+|\s+\z", "")
    for p in ("^https://doi\\.org/", "^http://doi\\.org/", "^doi:"):
        c = F.regexp_replace(c, p, "")
    return c


def paper_doi(c: Column) -> Column:
    """Lower case, without one address of the DOI resolver in front."""
    return F.regexp_replace(F.lower(c), r"^https?://(?:dx\.)?doi\.org/", "")


def file_arxiv_id(name: Column) -> Column:
    """The identifier in a fulltext file's name, null if there is none."""
    return F.nullif(F.regexp_extract(name, r"^(\d{4}\.\d{4,5})(?:v\d+)?\.md$", 1), F.lit(""))


def arxiv_doi(arxiv_id: Column) -> Column:
    return F.concat(F.lit("10.48550/arxiv."), arxiv_id)


def normalised_arxiv_id(c: Column) -> Column:
    doi = F.nullif(F.regexp_extract(c, rf"(?i)arXiv\.({NEW_ID})", 1), F.lit(""))
    c = F.when(c.startswith("10.48550"), F.coalesce(doi, c)).otherwise(c)
    url = F.nullif(F.regexp_extract(c, rf"(?i)abs/({NEW_ID}|{OLD_ID})", 1), F.lit(""))
    c = F.when(F.contains(F.lower(c), F.lit("arxiv.org")), F.coalesce(url, c)).otherwise(c)
    c = F.regexp_replace(c, r"v\d+$", "")
    return F.when(F.contains(c, F.lit("/")), F.lower(c)).otherwise(c)


def arxiv_ids(text: Column) -> Column:
    """Distinct normalised identifiers in a text, in the order of the patterns and then of the text."""
    patterns = [rf"(?i)10\.48550/arXiv\.({NEW_ID})", rf"(?i)arxiv\.org/abs/({NEW_ID})", rf"(?i)arxiv\.org/abs/({OLD_ID})", rf"\b({NEW_ID})(?:v\d+)?\b", rf"(?i)\b({OLD_ID})\b"]
    found = F.concat(*[F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(p), F.lit(1)) for p in patterns])
    return F.array_distinct(F.transform(found, normalised_arxiv_id))


def arxiv_content(readme: Column, description: Column) -> Column:
    """struct: readme, description (the identifiers in them), some (there is text): all that a match needs of a repository."""
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    return F.struct(arxiv_ids(readme).alias("readme"), arxiv_ids(description).alias("description"), (some(readme) | some(description)).alias("some"))


def arxiv_match(paper_id: Column, readme: Column, description: Column) -> Column:
    """struct: matched, location, found_id, skip_reason."""
    return arxiv_match_in(paper_id, arxiv_content(readme, description))


def arxiv_match_in(paper_id: Column, content: Column) -> Column:
    """arxiv_match for a repository whose texts have been searched (arxiv_content)."""
    want = normalised_arxiv_id(paper_id)
    at = F.when(F.array_contains(content["readme"], want), F.lit("readme")).when(F.array_contains(content["description"], want), F.lit("description"))
    skip = F.when(F.coalesce(paper_id, F.lit("")) == "", F.lit("no_paper_arxiv_id")).when(~content["some"], F.lit("no_content"))
    where = F.when(skip.isNull(), at)
    return F.struct(where.isNotNull().alias("matched"), where.alias("location"), F.when(where.isNotNull(), want).alias("found_id"), skip.alias("skip_reason"))
