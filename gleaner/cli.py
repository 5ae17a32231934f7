"""python -m gleaner.cli extract | validate | promote | heal-fulltext."""

from __future__ import annotations

import argparse
import importlib
import os
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .functions.identifiers import paper_doi
from .operators import fetch, fulltext, healing, papers, promote, records, validate
from .sources import files, repositories, schemas
from .sources.probers import GitProber, GraphqlProber, HttpProber

# Fixed value: where the code host's service answers.
ENDPOINT = "https://api.github.com/graphql"


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gleaner")
    sub = p.add_subparsers(dest="step", required=True)
    e = sub.add_parser("extract", help="find software links")
    e.add_argument("input")
    e.add_argument("-o", "--output")
    e.add_argument("--from-datacite-abstract", action="store_true", help="the input is JSON lines of records")
    e.add_argument("--id-column", default="relative_path")
    e.add_argument("--content-column", default="content")
    e.add_argument("--heal-markdown", action="store_true")
    v = sub.add_parser("validate", help="keep links that exist")
    v.add_argument("input")
    v.add_argument("-o", "--output")
    v.add_argument("--results", help="JSON lines of url, valid, method, error that are known; without --log nothing else is asked")
    v.add_argument("--log", help="folder of the probers' log, which all executors reach: links that it lacks are asked for, a killed run is taken up")
    v.add_argument("--keep-invalid", action="store_true")
    v.add_argument("--timeout", type=float, default=5.0)
    v.add_argument("--http-concurrency", type=int, default=100)
    v.add_argument("--workers", type=int, default=50, help="remote repositories that are listed at a time")
    v.add_argument("--endpoint", default=ENDPOINT)
    v.add_argument("--token-variable", default="GITHUB_TOKEN", help="environment variable with the service's token")
    v.add_argument("--spacing", type=float, default=3.0, help="seconds between calls of the service, over all lanes")
    v.add_argument("--no-validator", action="store_true", help="links that no prober knows are invalid, not left out")
    v.add_argument("--promote", action="store_true", help="fetch repository metadata, take it as validation, and promote")
    v.add_argument("--records", help="JSON lines of paper records, for --promote")
    v.add_argument("--metadata", help="JSON lines of repository metadata that is known, for --promote")
    v.add_argument("--threshold", type=int, default=promote.THRESHOLD)
    v.add_argument("--scorer", help="module:factory of an author classifier, importable on executors")
    for name in ("promote",):
        m = sub.add_parser(name, help="upgrade links that independent signals support")
        m.add_argument("input")
        m.add_argument("--records", required=True)
        m.add_argument("--metadata", required=True, help="JSON lines of repository metadata")
        m.add_argument("-o", "--output")
        m.add_argument("--threshold", type=int, default=promote.THRESHOLD)
        m.add_argument("--batch", action="store_true", help="a verdict for each link and DOI, the first promotion wins")
        m.add_argument("--scorer", help="module:factory of an author classifier, importable on executors")
    h = sub.add_parser("heal-fulltext", help="repair texts")
    h.add_argument("input")
    h.add_argument("-o", "--output")
    h.add_argument("--content-column")
    return p


def _flat(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("enrichedValue.relatedIdentifier").alias("url"), F.col("enrichedValue.relationType").alias("relation"))


def show(stats: DataFrame) -> None:
    """Prints metric, name, value: one row a kind and error."""
    for r in stats.orderBy("metric", F.col("value").desc(), "name").collect():
        print(" ".join(str(x) for x in r if x != ""))


def extract(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.from_datacite_abstract:
        out, figures = records.enrichments(files.read_records(spark, a.input), _now()), list
    else:
        docs = files.read_fulltext(spark, a.input, a.id_column, a.content_column)
        out, figures = fulltext.observed(healing.heal_table(docs) if a.heal_markdown else docs, _now())
    files.write_jsonl(out, a.output or files.default_output(a.input, "extract"))
    for row in figures():
        print(*[x for x in row if x != ""])


def scorer(name: str | None):
    """The factory that `module:factory` names."""
    if name is None:
        return None
    module, _, factory = name.partition(":")
    return getattr(importlib.import_module(module), factory)


def probers(a: argparse.Namespace) -> dict:
    """Kind of link to prober. Before anything is asked, the service says whether the token's scopes do."""
    http, git = HttpProber(a.timeout, a.http_concurrency, min(20, a.http_concurrency)), GitProber(a.timeout, a.workers, a.workers)
    post = repositories.Post(a.endpoint, os.environ.get(a.token_variable, ""))
    repositories.preflight(post)
    own = {"github": GraphqlProber(post, spacing=a.spacing, metadata=a.promote)}
    return own | dict.fromkeys(("gitlab", "bitbucket", "codeberg"), git) | dict.fromkeys(("pypi", "npm", "cran", "bioconductor", "zenodo", "figshare", "codeocean", "software_heritage"), http)


def _uri(path: str) -> str:
    return path if "://" in path else "file://" + os.path.abspath(path)


def _known(spark: SparkSession, path: str | None, schema: str, strict: bool = False) -> DataFrame:
    return files.last_of_each(files.with_order(spark, path, schema, strict)) if path else spark.createDataFrame([], schema)


def run_validate(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.promote and not a.records:
        raise SystemExit("--promote needs --records")
    if not (a.results or a.log):
        raise SystemExit("validate needs --results, --log or both")
    rows = _flat(files.with_order(spark, a.input, schemas.ENRICHMENT)).drop("_validation")
    results = _known(spark, a.results, schemas.CHECKPOINT, strict=True).select("url", "valid", "method", "error")
    repos = _known(spark, a.metadata, schemas.METADATA)
    if a.log:
        log, own = _uri(a.log), probers(a)
        urls = rows.where("url is not null and url != ''").select("url").distinct()
        if a.promote:  # one call gives both: what metadata says of a repository is its validation
            mine = validate.uncached(validate.categorised(urls).where("kind = 'github'"), results)
            repos = fetch.missing_metadata(mine, repos, f"{log}/metadata", own.pop("github"))
            results = results.unionByName(fetch.as_validation(repos.join(mine.select("url"), "url", "left_semi")))
        results = validate.check(urls, results, own, log, _now(), a.no_validator)
    out = validate.applied(rows, results, a.keep_invalid)
    out = out.withColumn("_validation", F.struct("is_valid", "method", "error")).orderBy("idx").drop("idx", "url", "relation", "is_valid", "method", "error")
    target = a.output or files.default_output(a.input, "validate-promote" if a.promote else "validate")
    if a.promote:
        checked = f"{target}.validated"
        files.write_jsonl(out, checked)
        files.write_jsonl(promoted(spark, checked, a.records, repos, a.threshold, True, scorer(a.scorer)), target)
    else:
        files.write_jsonl(out, target)
    show(validate.stats(results))


def promoted(spark: SparkSession, path: str, records_path: str, repos: DataFrame, threshold: int, batch: bool, factory=None) -> DataFrame:
    """The records of a file with their verdicts, in their order."""
    rows = _flat(files.with_order(spark, path, schemas.ENRICHMENT)).withColumn("is_valid", F.coalesce("_validation.is_valid", F.lit(False))).drop("_promotion")
    wanted = papers.read_wanted(spark, records_path, rows.select(paper_doi(F.col("doi")).alias("doi")))
    found = papers.by_doi(papers.papers(wanted)).drop("key")
    out = (promote.per_pair if batch else promote.per_url)(rows, found, repos, factory, threshold)
    skip = F.col("skip_reason") if batch else F.lit(None).cast("string")
    verdict = F.when(F.col("promoted").isNotNull(), F.struct("promoted", F.when(skip.isNotNull(), True).alias("skipped"), skip.alias("skip_reason"), "original_relation", "signals", "evidence"))
    value = F.col("enrichedValue").withField("relationType", F.col("relation"))
    out = out.withColumn("_promotion", verdict).withColumn("enrichedValue", value).orderBy("idx")
    return out.select(*[c for c in rows.columns if c not in ("idx", "url", "relation", "is_valid")], "_promotion")


def run_promote(spark: SparkSession, a: argparse.Namespace) -> None:
    repos = _known(spark, a.metadata, schemas.METADATA)
    out = promoted(spark, a.input, a.records, repos, a.threshold, a.batch, scorer(a.scorer))
    files.write_jsonl(out, a.output or files.default_output(a.input, "promote"))


def heal(spark: SparkSession, a: argparse.Namespace) -> None:
    df = spark.read.parquet(a.input)
    column = a.content_column or files.content_column(df)
    figures, warned = Observation(), F.size("healing_warnings") > 0  # taken in the writing pass
    healed = healing.heal_table(df, column).observe(figures, F.count("*").alias("total"), F.count_if(~warned).alias("healed"), F.count_if(warned).alias("warnings"))
    healed.drop("healing_warnings").write.parquet(a.output or files.default_output(a.input, "heal"))
    for k in ("total", "healed", "warnings"):
        print(k, figures.get[k])


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("gleaner").getOrCreate()
    try:
        {"extract": extract, "validate": run_validate, "promote": run_promote, "heal-fulltext": heal}[a.step](spark, a)
    except repositories.ScopeError as e:
        print(f"{e}\nadd one of these scopes to the token and start again", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
