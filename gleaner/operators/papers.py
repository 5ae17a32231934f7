"""Papers from bibliographic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import paper_doi
from ..sources import schemas
from ..sources.files import numbered_lines, parsed


def author_names(creators: Column) -> Column:
    """Names of persons: given and family name, else `Last, First` turned round."""
    some = lambda c: F.coalesce(c, F.lit("")) != ""

    def name(x: Column) -> Column:
        n = F.coalesce(x["name"], F.lit(""))
        turned = F.regexp_replace(n, r"(?s)^(.*?), (.*)$", "$2 $1")
        return F.when(some(x["givenName"]) & some(x["familyName"]), F.concat_ws(" ", x["givenName"], x["familyName"])).otherwise(turned)

    people = F.filter(creators, lambda x: x["nameType"] == "Personal")
    return F.coalesce(F.filter(F.transform(people, name), lambda n: n != ""), F.array().cast("array<string>"))


def datacite(records: DataFrame) -> DataFrame:
    """doi, title, authors, arxiv_id; and idx, if the records have it."""
    first = lambda array, kind, value: F.get(F.transform(F.filter(f"attributes.{array}", lambda x: x[kind] == "arXiv"), lambda x: x[value]), 0)
    alternate = F.nullif(first("alternateIdentifiers", "alternateIdentifierType", "alternateIdentifier"), F.lit(""))
    return records.select(
        F.coalesce(F.nullif("attributes.doi", F.lit("")), F.col("id")).alias("doi"), F.get("attributes.titles", 0)["title"].alias("title"), author_names(F.col("attributes.creators")).alias("authors"),
        F.coalesce(alternate, first("identifiers", "identifierType", "identifier")).alias("arxiv_id"), *[x for x in records.columns if x == "idx"],
    )


#: Kinds of records and what makes papers of them.
EXTRACTORS = {"datacite": datacite}


def papers(records: DataFrame, kind: str = "datacite") -> DataFrame:
    if kind not in EXTRACTORS:
        raise ValueError(f"{kind} is none of {list(EXTRACTORS)}")
    return EXTRACTORS[kind](records)


def wanted(records: DataFrame, dois: DataFrame) -> DataFrame:
    """Records whose lower-case DOI is in dois(doi). Spark broadcasts the DOIs if they are small."""
    key = F.lower(F.coalesce("attributes.doi", "id"))
    return records.withColumn("__k", key).join(dois.select(F.lower("doi").alias("__k")).distinct(), "__k", "left_semi").drop("__k")


def read_wanted(spark: SparkSession, path: str, dois: DataFrame) -> DataFrame:
    """idx and the fields of the records of a file whose lower-case DOI is in dois(doi). Two steps: only the DOI is read from
    each line, and lines that no DOI asks for are never parsed."""
    lines = numbered_lines(spark, path)
    key = F.lower(F.coalesce(F.get_json_object("value", "$.attributes.doi"), F.get_json_object("value", "$.id")))
    left = lines.withColumn("__k", key).join(dois.select(F.lower("doi").alias("__k")).distinct(), "__k", "left_semi")
    return parsed(left, schemas.RECORD)


def by_doi(found: DataFrame, order: str = "idx") -> DataFrame:
    """The last paper of each normalised DOI."""
    cols = [c for c in found.columns if c != order]
    return found.where("doi is not null").groupBy(paper_doi(F.col("doi")).alias("key")).agg(F.max_by(F.struct(*cols), order).alias("p")).select("key", "p.*")
