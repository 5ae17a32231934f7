"""Inputs of the registered queries, made from the driver's tables by arithmetic on their keys.

Every expression is written once, in the part of SQL that Spark and DuckDB share; `{S}` is the name of the string type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import spread

SPARK, DUCK = "string", "varchar"


def _n(expr: str) -> str:
    return f"cast({expr} as {{S}})"


def _text(pattern: str) -> str:
    """A text with <a> = doc_id % 17 and <b> = doc_id % 5 and <n> = a line end."""
    parts, out = pattern.replace("<a>", "\0a\0").replace("<b>", "\0b\0").replace("<n>", "\0n\0").split("\0"), []
    for i, p in enumerate(parts):
        if i % 2:
            out.append({"a": _n("doc_id % 17"), "b": _n("doc_id % 5"), "n": "chr(10)"}[p])
        elif p:
            out.append("'" + p + "'")
    return f"concat({', '.join([*out, chr(39) * 2])})"


# What documents get appended, by doc_id % 16: the cases of the extraction.
TAILS = [
    " see https://github.com/User<a>/repo<b>.git). Also (www.github.com/User<a>/Repo<b>/wiki) and github.com/user<a>/repo<b>",
    " code: git-<n>hub.com / lab<a> / tool<b> end",
    " g i t h u b . c o m/ab<a>/cd<b> and gitlab.com/g<a>/p<b>/-/tree/main",
    " bitbucket.org/t<a>/r<b>, codeberg.org/c<a>/d<b>; www.codeberg.org/c<a>/d<b> sourceforge.net/projects/sf<a>",
    " pip https://pypi.org/project/pkg<a>/ npm www.npmjs.com/package/@scope/p<b> cran.r-project.org/package=cr<a>.x",
    " anaconda.org/conda-forge/n<a> rubygems.org/gems/g<b> crates.io/crates/c<a> packagist.org/packages/v<a>/p<b>",
    " bioconductor.org/packages/B<a> archive.softwareheritage.org/swh:1:dir:abc<a>;origin=http://github.com/o<a>/q<b> codeocean.com/capsule/123<a>",
    " data https://github.com/d<a>/e<b>/blob/main/x.csv and github.com/d<a>/e<b>/issues/12 page me<a>.github.io/site",
    " soft git­hub.com/z<a>/y<b> zero​width github.com/a/...",
    " A &amp; B http://gitlab.com/H<a>/I<b>. GITHUB.COM/UP<a>/Case<b> githubXcom/k<a>/l<b>",
    " https://github.com/x<a>/y<b> https://github.com/X<a>/Y<b>/releases github.com/actions/checkout",
    " github.com /　n<a> / m<b> caf-<n>é-<n>été",
    " arXiv:2301.0<b>234v2 and 10.48550/arXiv.2308.11197, hep-th/9901001 https://arxiv.org/abs/math/0309136",
    "<n>• first<n>▪▪ second<n>12<n>Page 3 of 9<n>exam-<n>ple trans-<n>former<n><n><n><n><n>```<n>code  <n>Introduction<n>Done now, it is.",
    "<n>Running head<n>" * 30,
    "",
]
ID = "CASE WHEN doc_id % 11 = 3 THEN concat('note', " + _n("doc_id") + ", '.txt') ELSE concat('23', lpad(" + _n("doc_id % 12 + 1") + ", 2, '0'), '.', lpad(" + _n("doc_id % 100000") + ", 5, '0'), 'v', " + _n("doc_id % 3 + 1") + ", '.md') END"
CONTENT = "concat(coalesce(text, ''), CASE doc_id % 16 " + " ".join(f"WHEN {i} THEN {_text(t)}" for i, t in enumerate(TAILS)) + " END)"
CORPUS = {"doc_id": "doc_id", "id": ID, "content": CONTENT}

# Records: one a document; the description's type and the known identifier vary.
RECORDS = {
    "doc_id": "doc_id", "rec_id": "concat('10.5072/R', " + _n("doc_id - doc_id % 3") + ")", "kind": "CASE doc_id % 3 WHEN 0 THEN 'Abstract' WHEN 1 THEN 'Other' ELSE 'Methods' END", "text": CONTENT,
    "known": "CASE WHEN doc_id % 5 = 0 THEN concat('http://www.github.com/user', " + _n("doc_id % 17") + ", '/REPO', " + _n("doc_id % 5") + ", '/') WHEN doc_id % 5 = 1 THEN concat('gitlab.com/g', " + _n("doc_id % 17") + ", '/p', " + _n("doc_id % 5") + ") END",
    "title": "CASE WHEN doc_id % 6 > 0 THEN concat('Title ', " + _n("doc_id") + ") END", "given": "CASE WHEN doc_id % 4 = 0 THEN 'Ada' END", "family": "CASE WHEN doc_id % 4 < 2 THEN concat('Fam', " + _n("doc_id % 9") + ") END",
    "full_name": "CASE doc_id % 3 WHEN 0 THEN concat('Fam', " + _n("doc_id % 9") + ", ', Ada, Jr') WHEN 1 THEN 'Mono' ELSE '' END", "name_type": "CASE WHEN doc_id % 7 = 0 THEN 'Organizational' ELSE 'Personal' END",
    "arxiv": "CASE WHEN doc_id % 5 < 3 THEN concat('arXiv:', lpad(" + _n("doc_id % 10000") + ", 4, '0')) END", "other": "CASE WHEN doc_id % 2 = 0 THEN '2301.01234v3' END",
}

# Enrichments from orders, papers from parts, repositories from customers: whole tables. A link is its customer's, its DOIs are the customer's
# own number, its double and the order's number, so that pairs grow with the orders. Some papers and repositories are missing, as
# their keys have another form.
ENRICHED = {
    "idx": "o_orderkey", "url": "CASE WHEN o_orderkey % 10 = 9 THEN concat('https://gitlab.com/g', " + _n("o_custkey") + ", '/t') ELSE concat('https://github.com/lab', " + _n("o_custkey") + ", '/Deep-Parser', " + _n("o_custkey") + ") END",
    "doi": "concat(CASE WHEN o_orderkey % 4 = 0 THEN 'https://doi.org/' ELSE '' END, '10.1/P', " + _n("CASE o_orderkey % 3 WHEN 0 THEN o_custkey WHEN 1 THEN o_custkey * 2 ELSE o_orderkey END") + ")", "relation": "'References'", "is_valid": "o_orderkey % 7 <> 0",
}
PAPERS = {
    "k": "p_partkey", "doi": "concat(CASE WHEN p_partkey % 10 = 7 THEN '10.2/q' ELSE '10.1/p' END, " + _n("p_partkey") + ")", "title": "CASE p_partkey % 3 WHEN 0 THEN concat('The Deep Parser', " + _n("p_partkey") + ", ' for trees') WHEN 1 THEN p_name ELSE 'A study of deep-parser systems' END",
    "author": "concat('Author ', " + _n("p_partkey % 7") + ")", "arxiv_id": "CASE WHEN p_partkey % 5 > 0 THEN concat('2301.', lpad(" + _n("p_partkey") + ", 5, '0'), 'v1') END",
}
REPOS = {
    "k": "c_custkey", "url": "concat('https://github.com/', CASE WHEN c_custkey % 8 = 5 THEN 'moved' ELSE 'lab' END, " + _n("c_custkey") + ", '/Deep-Parser', " + _n("c_custkey") + ")", "description": "CASE WHEN c_custkey % 3 = 0 THEN concat('Code of arXiv:2301.', lpad(" + _n("c_custkey * 2") + ", 5, '0')) END",
    "readme_content": "CASE WHEN c_custkey % 2 = 0 THEN concat('See https://arxiv.org/abs/2301.', lpad(" + _n("c_custkey") + ", 5, '0'), ' please') END", "login": "concat('dev', " + _n("c_custkey") + ")", "name": "concat('Author ', " + _n("c_custkey % 7") + ")",
    "fetch_error": "CASE WHEN c_custkey % 13 = 0 THEN 'not_found' END",
}
# Links with probe results, from events: an append-only log.
LOG = {
    "idx": "event_id", "url": "concat('https://', CASE event_id % 7 WHEN 0 THEN 'github.com/a' WHEN 1 THEN 'pypi.org/project/python-gitlab' WHEN 2 THEN 'www.npmjs.com/package/p' WHEN 3 THEN 'zenodo.org/record/' WHEN 4 THEN 'cran.r-project.org/package=x' WHEN 5 THEN 'crates.io/crates/c' ELSE 'bioconductor.org/packages/release/bioc/B' END, " + _n("user_id") + ", CASE WHEN event_id % 7 = 0 THEN '/r.git' ELSE '' END)",
    "valid": "event_id % 3 = 0", "method": "CASE WHEN event_id % 7 = 0 THEN 'graphql' ELSE 'http_head' END", "error": "CASE WHEN event_id % 3 = 1 THEN concat('http_', " + _n("500 + event_id % 4") + ") END", "status": "CASE event_id % 6 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 410 ELSE 500 + event_id % 4 END",
    "code": "event_id % 4", "stderr": "CASE event_id % 5 WHEN 0 THEN 'Repository NOT FOUND' WHEN 1 THEN 'Permission denied' WHEN 2 THEN 'does not exist' WHEN 3 THEN 'Authentication failed' END",
}

TABLES = {"corpus": ("documents", CORPUS), "records": ("documents", RECORDS), "enriched": ("orders", ENRICHED), "papers": ("part", PAPERS), "repos": ("customer", REPOS), "log": ("events", LOG)}


def spark_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = TABLES[name]
    table = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    if name in ("corpus", "records"):  # long texts
        table = spread(table.select("doc_id", "text"))
    return table.selectExpr(*[f"{e.replace('{S}', SPARK)} AS {c}" for c, e in columns.items()])


def duck_table(name: str) -> str:
    source, columns = TABLES[name]
    return f"{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items()).replace('{S}', DUCK)} FROM {source})"


# Signs and accented letters, and what their UTF-8 bytes look like in code page 1252; what comes later makes none of the former.
BROKEN = {x: x.encode("utf-8").decode("cp1252") for x in "€“–’áéíóúñüçÉÓÚÑö"}


def broken(expr: str) -> str:
    """expr with these read by the wrong code page."""
    for good, bad in BROKEN.items():
        expr = f"replace({expr}, '{good}', '{bad}')"
    return expr
