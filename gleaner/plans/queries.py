"""The registered queries of the link engine, each beside its DuckDB form."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import healing, identifiers, links, similarity, textprep
from ..operators import authors, fetch, fulltext, papers, promote, records, validate
from ..operators import healing as heal_ops
from ..sources import lanes
from ..sources.files import last_of_each
from ..sources.folders import new_folder
from ..sources.probers import GraphqlProber, HttpProber, git_result, http_result
from . import duck
from .inputs import broken, spark_table

NOW = "2024-01-01T00:00:00Z"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
c = F.col


def query(name: str, oracle: str | None = None):
    def register(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return register


def corpus(spark: SparkSession, d: str) -> DataFrame:
    return spark_table(spark, d, "corpus")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return corpus(spark, d).select("id", "content")


# --- text preparation ---


def _prepared(name: str, f: Callable[[Column], Column], sql: Callable[[str], str], table: str = "corpus", column: str = "content") -> None:
    q = duck.chain(f"SELECT doc_id, md5(t) AS digest, length(t)::BIGINT AS n FROM (SELECT doc_id, {sql(column)} AS t FROM {table})", table)
    query(name, q)(lambda spark, d: spark_table(spark, d, table).select("doc_id", f(c(column)).alias("t")).select("doc_id", F.md5("t").alias("digest"), F.char_length("t").cast("long").alias("n")))


_prepared("textprep_invisible", textprep.strip_invisible, duck.invisible)
_prepared("textprep_hyphen", textprep.join_hyphenated, duck.hyphen)
_prepared("textprep_slash", textprep.tighten_slashes, duck.slash)
_prepared("textprep_spaced_domains", textprep.mend_domains, duck.domains)
_prepared("textprep_record_domains", textprep.mend_record_domains, lambda x: duck.domains(x, textprep.RECORD_DOMAINS, "gi", False))
_prepared("textprep_fulltext", textprep.prepare_fulltext, duck.fulltext)
_prepared("textprep_record", textprep.prepare_record, duck.record, "records", "text")
_prepared("html_unescape", textprep.unescape_html, lambda x: f"replace({x}, '&amp;', '&')")
# References of all kinds after the text, by doc_id: names with and without a semicolon, numbers, the old code page, none.
ENTITIES = [("&lt;a&gt; &eacute;", "<a> é"), ("&copy2 &notit; &notin;", "©2 ¬it; ∉"), ("&#233;&#xE9&#x1F600;", "éé😀"), ("&#128;&#0;&#xD800;&#x110000;", "€���"), ("R&D; a&b=1&amp=2 &", "R&D; a&b=1&=2 &"), ("&#1;&#x7f;&AMP", "&")]


def _by_id(place: int) -> str:
    quoted = [e[place].replace("'", "''") for e in ENTITIES]
    return f"CASE doc_id % {len(ENTITIES)} " + " ".join(f"WHEN {i} THEN '{q}'" for i, q in enumerate(quoted)) + " END"


@query("html_entities", duck.chain(f"SELECT doc_id, md5(t) AS digest, length(t)::BIGINT AS n FROM (SELECT doc_id, concat(replace(content, '&amp;', '&'), ' ', {_by_id(1)}) AS t FROM corpus)", "corpus"))
def html_entities(spark, d):
    told = textprep.unescape_html(F.concat("content", F.lit(" "), F.expr(_by_id(0))))
    return corpus(spark, d).select("doc_id", told.alias("t")).select("doc_id", F.md5("t").alias("digest"), F.char_length("t").cast("long").alias("n"))




# --- fulltext ---

_HIT = "doc_id, pattern_idx::BIGINT AS pattern_idx, pos::BIGINT AS pos, type, url"


def _hit(df: DataFrame) -> DataFrame:
    return df.select("doc_id", c("pattern_idx").cast("long").alias("pattern_idx"), c("pos").cast("long").alias("pos"), "type", "url")


query("extract_all_fulltext", duck.chain(f"SELECT {_HIT} FROM hits", "corpus", duck.PREP, duck.hits()))(lambda s, d: _hit(fulltext.extract(_docs(s, d))))
for _group, _names in {"code_hosts": [*links.CODE_HOSTS, "sourceforge"], "packages": links.PACKAGES, "archives": links.ARCHIVES}.items():
    query(f"extract_{_group}", duck.chain(f"SELECT {_HIT} FROM hits", "corpus", duck.PREP, duck.hits(_names)))(lambda s, d, names=_names: _hit(fulltext.extract(_docs(s, d)).where(c("type").isin(names))))
query("exclude_filter", duck.chain(f"SELECT {_HIT} FROM kept", "corpus", duck.PREP, duck.hits(), duck.KEPT))(lambda s, d: _hit(fulltext.keep_wanted(fulltext.extract(_docs(s, d)))))
query("normalize_urls", duck.chain(f"SELECT {_HIT} FROM normed", "corpus", duck.PREP, duck.hits(), duck.KEPT, duck.NORMED))(lambda s, d: _hit(fulltext.normalise(fulltext.keep_wanted(fulltext.extract(_docs(s, d))))))
query("dedup_keep_first", duck.chain(f"SELECT {_HIT} FROM first", *duck.FOUND))(lambda s, d: _hit(fulltext.found(_docs(s, d))))


@query("regroup_left_join", duck.chain("SELECT corpus.id, count(first.type)::BIGINT AS n_urls, coalesce(string_agg(CASE WHEN type IS NOT NULL THEN coalesce(url, 'null') END, '|' ORDER BY pattern_idx, pos), '') AS urls FROM corpus LEFT JOIN first ON corpus.id = first.doc_id GROUP BY corpus.id", *duck.FOUND))
def regroup_left_join(spark, d):
    flat = F.array_join(F.transform("urls", lambda x: F.coalesce(x["url"], F.lit("null"))), "|")
    return fulltext.with_urls(_docs(spark, d)).select("id", F.size("urls").cast("long").alias("n_urls"), flat.alias("urls"))


_ARXIV_FILE = r"^(\d{4}\.\d{4,5})(?:v\d+)?\.md$"


@query("emit_enrichments", duck.chain(f"SELECT '10.48550/arxiv.' || regexp_extract(doc_id, {duck.lit(_ARXIV_FILE)}, 1) AS doi, url AS related_identifier, 'URL' AS related_type, 'References' AS relation_type, 'insert_child' AS action, 'relatedIdentifiers' AS field, {duck.lit(NOW)} AS created FROM first WHERE regexp_matches(doc_id, {duck.lit(_ARXIV_FILE)})", *duck.FOUND))
def emit_enrichments(spark, d):
    e = c("enrichedValue")
    return fulltext.enrichments(_docs(spark, d), NOW).select("doi", e["relatedIdentifier"].alias("related_identifier"), e["relatedIdentifierType"].alias("related_type"), e["relationType"].alias("relation_type"), "action", "field", "created")


query("extract_stats", duck.chain(f"""SELECT 'total_papers' AS metric, '' AS name, count(*)::BIGINT AS value FROM corpus
UNION ALL SELECT 'papers_with_urls', '', count(DISTINCT doc_id)::BIGINT FROM mine UNION ALL SELECT 'total_urls', '', count(*)::BIGINT FROM mine UNION ALL SELECT 'urls_by_type', type, count(*)::BIGINT FROM mine GROUP BY type""", *duck.FOUND, f"mine AS (SELECT * FROM first WHERE regexp_matches(doc_id, {duck.lit(_ARXIV_FILE)}))"))(lambda s, d: fulltext.stats(_docs(s, d)))


# --- records ---


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return spark_table(spark, d, "records").select("rec_id", c("doc_id").alias("part"), "text")


_RHIT = "rec_id, doc_id AS part, pattern_idx::BIGINT AS pattern_idx, pos::BIGINT AS pos, type, url, base"
_RSTEPS = ("records", duck.RPREP, duck.record_hits(), duck.RNAMED, duck.RFIRST)


def _rhit(df: DataFrame) -> DataFrame:
    return df.select("rec_id", "part", c("pattern_idx").cast("long").alias("pattern_idx"), c("pos").cast("long").alias("pos"), "type", "url", "base")


query("record_extract", duck.chain(f"SELECT {_RHIT} FROM rfirst", *_RSTEPS))(lambda s, d: _rhit(records.extract(_texts(s, d))))
for _name, _kinds in {"package_canonical": links.PACKAGES, "repo_canonical": [*links.CODE_HOSTS, "sourceforge"], "archive_canonical": links.ARCHIVES}.items():

    @query(_name, duck.chain(f"SELECT doc_id, type, link, url FROM (SELECT *, {duck.canonical()} AS url FROM rhits) WHERE type IN ({', '.join(map(duck.lit, _kinds))})", "records", duck.RPREP, duck.record_hits()))
    def canonical_of(spark, d, kinds=_kinds):
        t = spark_table(spark, d, "records").select("doc_id", textprep.prepare_record(c("text")).alias("t"))
        each = t.select("doc_id", F.inline(records.hits(c("t"), F.lower("t")))).where(c("type").isin(kinds))
        return each.select("doc_id", "type", "link", links.canonical(c("type"), c("link"), c("group")).alias("url"))


query("base_repo_key", f"SELECT page_id, {duck.base_key('url')} AS base FROM pages")(lambda s, d: s.read.parquet(f"{d}/pages.parquet").select("page_id", links.base_key(c("url")).alias("base")))


def _known(spark: SparkSession, d: str) -> DataFrame:
    return spark_table(spark, d, "records").select("rec_id", c("known").alias("identifier"), F.lit("URL").alias("kind"))


_KNOWN = f"known AS (SELECT DISTINCT rec_id, {duck.base_key('known')} AS base FROM records WHERE known IS NOT NULL)"
query("existing_anti_match", duck.chain(f"SELECT {_RHIT} FROM rfirst ANTI JOIN known USING (rec_id, base)", *_RSTEPS, _KNOWN))(lambda s, d: _rhit(records.not_known(records.extract(_texts(s, d)), _known(s, d))))


@query("record_enrichments", duck.chain("SELECT rec_id AS doi, url AS related_identifier, 'IsSupplementedBy' AS relation_type, doc_id AS part FROM (SELECT *, row_number() OVER (PARTITION BY rec_id, url ORDER BY doc_id, pattern_idx, pos) AS k FROM rfirst ANTI JOIN known USING (rec_id, base)) WHERE k = 1", "records", duck.RPREP_WANTED, duck.record_hits(), duck.RNAMED, duck.RFIRST, _KNOWN))
def record_enrichments(spark, d):
    wanted = spark_table(spark, d, "records").where("kind in ('Abstract', 'Other') and text != ''").select("rec_id", c("doc_id").alias("part"), "text")
    return records.unique_links(wanted, _known(spark, d)).select(c("rec_id").alias("doi"), c("url").alias("related_identifier"), F.lit("IsSupplementedBy").alias("relation_type"), "part")


# --- identifiers and papers ---

_DOIS = "CASE doc_id % 5 WHEN 0 THEN concat('  https://doi.org/10.1/AB', n) WHEN 1 THEN concat('http://dx.doi.org/10.1/AB', n) WHEN 2 THEN concat('DOI:10.1/Ab', n, ' ') WHEN 3 THEN concat('https://doi.org/doi:10.1/ab', n) ELSE concat('10.1/AB', n) END"


def _dois(spark: SparkSession, d: str) -> DataFrame:
    return corpus(spark, d).select("doc_id", c("doc_id").cast("string").alias("n")).selectExpr("doc_id", f"{_DOIS} AS raw")


_DUCK_DOIS = f"dois AS (SELECT doc_id, {_DOIS} AS raw FROM (SELECT doc_id, doc_id::VARCHAR AS n FROM documents))"
_A = duck.sub(duck.sub(duck.sub("trim(lower(raw))", "^https://doi[.]org/", "", ""), "^http://doi[.]org/", "", ""), "^doi:", "", "")
query("doi_normalize_a", duck.chain(f"SELECT doc_id, {_A} AS doi FROM dois", _DUCK_DOIS))(lambda s, d: _dois(s, d).select("doc_id", identifiers.record_doi(c("raw")).alias("doi")))
query("doi_normalize_b", duck.chain(f"SELECT doc_id, {duck.sub('lower(raw)', '^https?://(?:dx[.])?doi[.]org/', '', '')} AS doi FROM dois", _DUCK_DOIS))(lambda s, d: _dois(s, d).select("doc_id", identifiers.paper_doi(c("raw")).alias("doi")))


def _datacite(spark: SparkSession, d: str) -> DataFrame:
    """The records table in the shape of bibliographic JSON."""
    none = F.lit(None).cast("array<struct<x:int>>")
    person = F.struct(c("full_name").alias("name"), c("given").alias("givenName"), c("family").alias("familyName"), c("name_type").alias("nameType"))
    second = F.struct(F.lit("Solo, Han").alias("name"), F.lit(None).cast("string").alias("givenName"), F.lit("x").alias("familyName"), F.lit("Personal").alias("nameType"))
    alt = F.struct(c("arxiv").alias("alternateIdentifier"), F.lit("arXiv").alias("alternateIdentifierType"))
    ids = F.array(F.struct(F.lit("123").alias("identifier"), F.lit("DOI").alias("identifierType")), F.struct(c("other").alias("identifier"), F.lit("arXiv").alias("identifierType")))
    attrs = F.struct(F.when(c("doc_id") % 2 == 0, F.upper("rec_id")).alias("doi"), F.when(c("title").isNotNull(), F.array(F.struct("title"))).alias("titles"), F.when(c("doc_id") % 13 > 0, F.array(person, second)).alias("creators"), F.when(c("doc_id") % 4 > 0, F.array(alt)).alias("alternateIdentifiers"), ids.alias("identifiers"), none.alias("nothing"))
    return spark_table(spark, d, "records").select("doc_id", c("rec_id").alias("id"), attrs.alias("attributes"))


_NAME = "CASE WHEN coalesce(given, '') <> '' AND coalesce(family, '') <> '' THEN given || ' ' || family ELSE regexp_replace(full_name, '(?s)^(.*?), (.*)$', '\\2 \\1') END"
_AUTHORS = f"CASE WHEN doc_id % 13 = 0 THEN '' WHEN name_type = 'Personal' AND {_NAME} <> '' THEN {_NAME} || '|Han Solo' ELSE 'Han Solo' END"
_PAPER = f"SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN upper(rec_id) ELSE rec_id END AS doi, title, {_AUTHORS} AS authors, CASE WHEN doc_id % 4 > 0 AND arxiv IS NOT NULL THEN arxiv ELSE other END AS arxiv_id FROM records"



@query("paper_projection", duck.chain(_PAPER, "records"))
def paper_projection(spark, d):
    r = _datacite(spark, d).withColumn("attributes", c("attributes"))
    p = papers.datacite(r.select(F.concat_ws("\x01", "id", c("doc_id").cast("string")).alias("id"), F.struct(F.concat_ws("\x01", F.coalesce("attributes.doi", "id"), c("doc_id").cast("string")).alias("doi"), "attributes.titles", "attributes.creators", "attributes.alternateIdentifiers", "attributes.identifiers").alias("attributes")))
    part = F.split("doi", "\x01")
    return p.select(F.get(part, 1).cast("long").alias("doc_id"), F.get(part, 0).alias("doi"), "title", F.array_join("authors", "|").alias("authors"), "arxiv_id")


query("author_names", duck.chain(f"SELECT doc_id, {_AUTHORS} AS authors FROM records", "records"))(lambda s, d: _datacite(s, d).select("doc_id", F.array_join(papers.author_names(c("attributes.creators")), "|").alias("authors")))
_WANT = "SELECT DISTINCT concat('10.5072/r', cast(doc_id % 300 as {S})) AS doi FROM documents"
query("paper_semi_join", duck.chain(f"SELECT doc_id, rec_id AS id FROM records WHERE lower(rec_id) IN ({_WANT.replace('{S}', 'varchar')})", "records"))(lambda s, d: papers.wanted(_datacite(s, d), s.read.parquet(f"{d}/documents.parquet").selectExpr("concat('10.5072/r', cast(doc_id % 300 as string)) AS doi").distinct()).select("doc_id", "id"))


@query("paper_last_wins", duck.chain("SELECT lower(rec_id) AS key, max(doc_id) AS doc_id, arg_max(coalesce(title, 'none'), doc_id) AS title FROM records GROUP BY 1", "records"))
def paper_last_wins(spark, d):
    p = _datacite(spark, d).select(c("id").alias("doi"), F.coalesce(F.get("attributes.titles", 0)["title"], F.lit("none")).alias("title"), "doc_id", c("doc_id").alias("idx"))
    return papers.by_doi(p).select("key", "doc_id", "title")


_RAW_IDS = "CASE doc_id % 6 WHEN 0 THEN concat('10.48550/arXiv.2308.1', lpad(n, 4, '0')) WHEN 1 THEN concat('https://arxiv.org/abs/2301.0', lpad(n, 4, '0'), 'v3') WHEN 2 THEN 'http://ARXIV.org/abs/HEP-th/9901001v2' WHEN 3 THEN concat('2301.', lpad(n, 5, '0'), 'v12') WHEN 4 THEN 'Math/0309136' ELSE concat('odd v', n) END"
query("arxiv_normalize", f"SELECT doc_id, {duck.arxiv_id('raw')} AS arxiv_id FROM (SELECT doc_id, {_RAW_IDS} AS raw FROM (SELECT doc_id, doc_id::VARCHAR AS n FROM documents))")(lambda s, d: corpus(s, d).select("doc_id", c("doc_id").cast("string").alias("n")).selectExpr("doc_id", f"{_RAW_IDS} AS raw").select("doc_id", identifiers.normalised_arxiv_id(c("raw")).alias("arxiv_id")))
query("arxiv_ids", duck.chain(f"SELECT doc_id, array_to_string(list_sort({duck.arxiv_ids('content')}), '|') AS ids FROM corpus", "corpus"))(lambda s, d: corpus(s, d).select("doc_id", F.array_join(F.array_sort(identifiers.arxiv_ids(c("content"))), "|").alias("ids")))

_DETECT = "CASE WHEN doc_id % 5 = 4 THEN NULL WHEN doc_id % 2 = 0 THEN '2308.11197v2' ELSE 'Math/0309136' END"
_READ, _DESC = "CASE WHEN doc_id % 3 > 0 THEN content END", "CASE WHEN doc_id % 3 = 0 AND doc_id % 7 > 0 THEN content END"


@query("arxiv_detect", duck.chain(f"""SELECT doc_id, loc IS NOT NULL AS matched, loc AS location, CASE WHEN loc IS NOT NULL THEN want END AS found_id, skip AS skip_reason FROM (SELECT doc_id, want, skip, CASE WHEN skip IS NOT NULL THEN NULL WHEN list_contains({duck.arxiv_ids('r')}, want) THEN 'readme' WHEN list_contains({duck.arxiv_ids('d')}, want) THEN 'description' END AS loc
FROM (SELECT *, {duck.arxiv_id('p')} AS want, CASE WHEN coalesce(p, '') = '' THEN 'no_paper_arxiv_id' WHEN coalesce(r, '') = '' AND coalesce(d, '') = '' THEN 'no_content' END AS skip FROM (SELECT doc_id, {_DETECT} AS p, {_READ} AS r, {_DESC} AS d FROM corpus)))""", "corpus"))
def arxiv_detect(spark, d):
    t = corpus(spark, d).selectExpr("doc_id", f"{_DETECT} AS p", f"{_READ} AS r", f"{_DESC} AS d")
    return t.select("doc_id", identifiers.arxiv_match(c("p"), c("r"), c("d")).alias("m")).select("doc_id", "m.*")


# --- similarity ---

_PAIR = "pairs AS (SELECT p_partkey AS k, 'The_' || p_name || '-Tool' AS a, p_brand || ' ' || p_type || ': a Tool for ' || p_name AS b FROM part)"


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/part.parquet").selectExpr("p_partkey AS k", "concat('The_', p_name, '-Tool') AS a", "concat(p_brand, ' ', p_type, ': a Tool for ', p_name) AS b")


_TOK = f"tok AS (SELECT k, a, b, {duck.tokens('a')} AS ta, {duck.tokens('b')} AS tb FROM pairs)"
_BOTH = "len(list_intersect(ta, tb))::DOUBLE"
_CONT, _JAC = f"greatest({_BOTH} / len(ta), {_BOTH} / len(tb))", f"({_BOTH} / len(list_distinct(ta || tb)))"
_FUZZY = f"(1.0::DOUBLE - (length(sa) + length(sb) - 2 * {duck.lcs('sa', 'sb')})::DOUBLE / (length(sa) + length(sb)))"
query("token_set", duck.chain("SELECT k, array_to_string(ta, ' ') AS ta, array_to_string(tb, ' ') AS tb FROM tok", _PAIR, _TOK))(lambda s, d: _pairs(s, d).select("k", F.array_join(similarity.tokens(c("a")), " ").alias("ta"), F.array_join(similarity.tokens(c("b")), " ").alias("tb")))
query("containment", duck.chain(f"SELECT k, round({_CONT}, 6) AS score FROM tok", _PAIR, _TOK))(lambda s, d: _pairs(s, d).select("k", F.round(similarity.containment(similarity.tokens(c("a")), similarity.tokens(c("b"))), 6).alias("score")))
query("jaccard", duck.chain(f"SELECT k, round({_JAC}, 6) AS score FROM tok", _PAIR, _TOK))(lambda s, d: _pairs(s, d).select("k", F.round(similarity.jaccard(similarity.tokens(c("a")), similarity.tokens(c("b"))), 6).alias("score")))
_STR = "str AS (SELECT *, array_to_string(ta, ' ') AS sa, array_to_string(tb, ' ') AS sb FROM tok)"
query("indel_ratio", duck.chain(f"SELECT k, round({_FUZZY}, 6) AS score FROM str", _PAIR, _TOK, _STR))(lambda s, d: _pairs(s, d).select("k", F.round(similarity.indel_ratio(F.array_join(similarity.tokens(c("a")), " "), F.array_join(similarity.tokens(c("b")), " ")), 6).alias("score")))
query("name_score", duck.chain(f"SELECT k, s >= 0.45 AS matched, round(s, 6) AS score FROM (SELECT k, 0.4::DOUBLE * {_CONT} + 0.4::DOUBLE * {_JAC} + 0.2::DOUBLE * {_FUZZY} AS s FROM str)", _PAIR, _TOK, _STR))(lambda s, d: _pairs(s, d).select("k", similarity.name_match(c("a"), c("b")).alias("m")).select("k", "m.matched", F.round("m.score", 6).alias("score")))


# --- validation ---


def _log(spark: SparkSession, d: str) -> DataFrame:
    return spark_table(spark, d, "log")


query("url_dedup", duck.chain("SELECT url, min(idx) AS first_idx, count(*)::BIGINT AS n, sum(idx)::BIGINT AS idx_sum FROM log GROUP BY url", "log"))(lambda s, d: validate.unique_urls(_log(s, d), F.sum("idx").alias("idx_sum")).select("url", "first_idx", "n", "idx_sum"))
query("url_categorize", duck.chain(f"SELECT DISTINCT url, {duck.category('url')} AS kind FROM log", "log"))(lambda s, d: validate.categorised(validate.unique_urls(_log(s, d)).select("url")))
query("cache_last_wins", duck.chain("SELECT url, max(idx) AS idx, arg_max(valid, idx) AS valid, arg_max(method, idx) AS method, arg_max(coalesce(error, '-'), idx) AS error FROM log GROUP BY url", "log"))(lambda s, d: last_of_each(_log(s, d).select("url", "valid", "method", F.coalesce("error", F.lit("-")).alias("error"), "idx", c("idx").alias("at")), order="at").select("url", "idx", "valid", "method", "error"))
query("cache_anti", duck.chain("SELECT DISTINCT url FROM log WHERE url NOT IN (SELECT url FROM log WHERE idx % 5 = 0)", "log"))(lambda s, d: validate.uncached(_log(s, d).select("url").distinct(), _log(s, d).where("idx % 5 = 0").select("url").distinct()))
# Results of the whole log; every second row's link has another form, that no link of the log has.
_RES = "res AS (SELECT url, arg_max(valid, idx) AS valid, arg_max(method, idx) AS method, arg_max(coalesce(error, '-'), idx) AS error FROM (SELECT * REPLACE (CASE WHEN idx % 2 = 0 THEN url ELSE replace(url, 'https:', 'http:') END AS url) FROM log) GROUP BY url)"


def _results(spark: SparkSession, d: str) -> DataFrame:
    return last_of_each(_log(spark, d).select(F.when(c("idx") % 2 == 0, c("url")).otherwise(F.replace("url", F.lit("https:"), F.lit("http:"))).alias("url"), "valid", "method", F.coalesce("error", F.lit("-")).alias("error"), "idx"))


for _keep in (False, True):
    query("apply_validation_keep_invalid" if _keep else "apply_validation", duck.chain("SELECT log.idx, log.url, res.valid AS is_valid, res.method, res.error FROM log JOIN res USING (url)" + ("" if _keep else " WHERE res.valid"), "log", _RES))(lambda s, d, keep=_keep: validate.applied(_log(s, d).select("idx", "url"), _results(s, d), keep).select("idx", "url", "is_valid", "method", "error"))
query("validation_stats", duck.chain("""SELECT metric, name, count(*)::BIGINT AS value FROM (
SELECT 'total' AS metric, '' AS name FROM r UNION ALL SELECT 'state', state FROM r UNION ALL SELECT 'kind', kind || ':' || state FROM r UNION ALL SELECT 'error', kind || ':' || error FROM r WHERE NOT valid) GROUP BY metric, name""", "log", f"r AS (SELECT {duck.category('url')} AS kind, valid, CASE WHEN valid THEN 'valid' ELSE 'invalid' END AS state, coalesce(error, 'unknown') AS error FROM log)"))(lambda s, d: validate.stats(_log(s, d)))


@query("http_status_map", duck.chain("SELECT idx, status = 200 AS valid, CASE WHEN status = 200 THEN NULL WHEN status = 404 THEN 'not_found' WHEN status = 410 AND contains(url, 'zenodo') THEN 'gone' ELSE 'http_' || status::VARCHAR END AS error FROM log", "log"))
def http_status_map(spark, d):
    valid, error = http_result(c("status"), F.contains("url", F.lit("zenodo")))
    return _log(spark, d).select("idx", valid.alias("valid"), error.alias("error"))


@query("git_rc_map", duck.chain("SELECT idx, code = 0 AS valid, CASE WHEN code = 0 THEN NULL WHEN code = 2 THEN 'not_found' WHEN contains(e, 'not found') OR contains(e, 'does not exist') THEN 'not_found' WHEN contains(e, 'permission denied') OR contains(e, 'authentication') THEN 'auth_required' ELSE 'error' END AS error FROM (SELECT *, lower(coalesce(stderr, '')) AS e FROM log)", "log"))
def git_rc_map(spark, d):
    valid, error = git_result(c("code"), c("stderr"))
    return _log(spark, d).select("idx", valid.alias("valid"), error.alias("error"))


_x = lambda p: f"nullif(regexp_extract(url, {duck.lit(p)}, 1), '')"
query("api_url_map", duck.chain(f"""SELECT DISTINCT url, CASE kind WHEN 'pypi' THEN 'https://pypi.org/pypi/' || {_x('pypi[.]org/project/([^/]+)')} || '/json' WHEN 'npm' THEN 'https://registry.npmjs.org/' || {_x('npmjs[.]com/package/([^/]+)')}
WHEN 'cran' THEN 'https://cran.r-project.org/package=' || {_x('cran[.]r-project[.]org/(?:web/)?package[s]?[=/]([^/&]+)')} WHEN 'bioconductor' THEN 'https://bioconductor.org/packages/' || {_x('bioconductor[.]org/packages/(?:release/|devel/)?(?:bioc|data|workflows)?/?([^/]+)')}
WHEN 'zenodo' THEN url END AS address FROM (SELECT url, CASE WHEN contains(url, 'python-gitlab') THEN 'pypi' ELSE {duck.category('url')} END AS kind FROM log)""", "log"))(lambda s, d: _log(s, d).select("url").distinct().select("url", links.check_url(c("url"), F.when(F.contains("url", F.lit("python-gitlab")), "pypi").otherwise(links.category(c("url")))).alias("address")))


@query("repo_parse", duck.chain(r"SELECT idx, nullif(regexp_extract(url, 'github[.]com/([^/]+)/([^/?#]+)', 1), '') AS owner, nullif(regexp_replace(regexp_extract(url, 'github[.]com/([^/]+)/([^/?#]+)', 2), '[.]git$', ''), '') AS repo FROM log", "log"))
def repo_parse(spark, d):
    owner, repo = links.repo_parts(c("url"))
    return _log(spark, d).select("idx", owner.alias("owner"), repo.alias("repo"))


# Responses of three repositories each, by c_custkey: a full one, one without readme and people, a missing one.
_RESPONSE = """CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 11 = 1 THEN '{"message": "Bad"}' ELSE concat('{"data": {"repo0": {"id": "a", "description": "D', n, '", "readme_md": ', CASE WHEN c_custkey % 2 = 0 THEN 'null' ELSE '{"text": ""}' END,
', "readme_rst": {"text": "rst ', n, '"}, "mentionableUsers": {"nodes": [{"login": "u', n, '", "name": null, "email": ""}, null]}}, "repo1": {"id": "b"}, "repo2": null}, "errors": [{"path": ["repo2"], "type": "', CASE WHEN c_custkey % 3 = 0 THEN 'FORBIDDEN' ELSE 'NOT_FOUND' END, '"}]}') END"""


def _responses(spark: SparkSession, d: str) -> DataFrame:
    t = spark.read.parquet(f"{d}/customer.parquet").selectExpr("c_custkey", "cast(c_custkey as string) AS n")
    urls = F.array(*[F.concat(F.lit("https://github.com/o"), "n", F.lit(f"/r{i}")) for i in range(3)])
    return t.selectExpr("n", f"{_RESPONSE} AS response").select(urls.alias("urls"), "response")


_RESP = f"resp AS (SELECT n, i, 'https://github.com/o' || n || '/r' || i::VARCHAR AS url, k % 11 AS m, k % 2 AS even, k % 3 AS third FROM (SELECT c_custkey AS k, c_custkey::VARCHAR AS n, unnest(range(3)) AS i FROM customer))"
query("graphql_existence", duck.chain("SELECT url, m > 1 AND i < 2 AS valid, CASE WHEN m = 0 THEN 'request_failed' WHEN m = 1 THEN 'api_error' WHEN i < 2 THEN NULL WHEN third = 0 THEN 'FORBIDDEN' ELSE 'NOT_FOUND' END AS error FROM resp", _RESP))(lambda s, d: validate.existence(_responses(s, d)))


@query("graphql_decode", duck.chain("SELECT url, CASE WHEN m > 1 AND i = 0 THEN 'D' || n END AS description, CASE WHEN m > 1 AND i = 0 THEN 'rst ' || n END AS readme_content, CASE WHEN m > 1 AND i = 0 THEN 'u' || n WHEN m > 1 AND i = 1 THEN '' END AS logins, CASE WHEN m = 0 THEN 'request_failed' WHEN m = 1 OR i = 2 THEN 'not_found' END AS fetch_error FROM resp", _RESP))
def graphql_decode(spark, d):
    return validate.metadata(_responses(spark, d)).select("url", "description", "readme_content", F.array_join(F.transform("contributors", lambda x: x["login"]), "|").alias("logins"), "fetch_error")


# --- asking ---

_MD5 = lambda x: f"('0x' || substr(md5({x}), 1, 8))::BIGINT"
_HOST = "regexp_extract(url, '^(?:https?://)?([^/]+)', 1)"


@query("probe_lanes", duck.chain(f"SELECT DISTINCT url, (({_MD5(_HOST)} + {_MD5('url')} % 20) % 100)::INTEGER AS lane FROM log", "log"))
def probe_lanes(spark, d):
    return lanes.dealt(_log(spark, d).select("url").distinct(), HttpProber()).select("url", "lane")


def _service(query: str) -> tuple[int, dict, str]:
    """A code host that is asked for lab<k>/Deep-Parser<k>: every 13th does not exist, every 7th has no README."""
    import json
    import re

    data = {}
    for alias, k in re.findall(r'(repo\d+): repository\(owner: "lab(\d+)"', query):
        readme = {"readme_md": {"text": f"Read {k}"}} if int(k) % 7 else {}
        data[alias] = None if int(k) % 13 == 0 else {"id": k, "description": f"Code {k}", "mentionableUsers": {"nodes": [{"login": f"dev{k}", "name": None, "email": ""}]}, **readme}
    return 200, {}, json.dumps({"data": data})


_FETCH = [
    "enriched", "repos",
    "asked AS (SELECT DISTINCT url, nullif(regexp_extract(url, 'github[.]com/lab([0-9]+)/', 1), '')::BIGINT AS n FROM enriched WHERE contains(url, 'github.com'))",
    "known AS (SELECT url, description, readme_content, login, fetch_error FROM repos WHERE k % 3 = 0)",
    "got AS (SELECT url, CASE WHEN n % 13 > 0 THEN 'Code ' || n::VARCHAR END AS description, CASE WHEN n % 13 > 0 AND n % 7 > 0 THEN 'Read ' || n::VARCHAR END AS readme_content, CASE WHEN n % 13 > 0 THEN 'dev' || n::VARCHAR END AS login, CASE WHEN n % 13 = 0 THEN 'not_found' END AS fetch_error FROM asked WHERE url NOT IN (SELECT url FROM known))",
    "meta AS (SELECT * FROM known UNION ALL SELECT * FROM got)",
]


def _fetched(spark: SparkSession, d: str) -> DataFrame:
    """Metadata of all linked repositories: a third of `repos` is known, the others are asked for."""
    asked = _enriched(spark, d).where(F.contains("url", F.lit("github.com"))).select("url").distinct()
    person = F.array(F.struct("login", "name", F.lit(None).cast("string").alias("email"))).alias("contributors")
    known = spark_table(spark, d, "repos").where("k % 3 = 0").select("url", "description", "readme_content", person, "fetch_error")
    return fetch.missing_metadata(asked, known, new_folder(spark, "fetch"), GraphqlProber(_service, spacing=0.0, metadata=True))


@query("fetch_missing", duck.chain("SELECT url, description, readme_content, coalesce(login, '') AS login, fetch_error FROM meta", *_FETCH))
def fetch_missing(spark, d):
    login = F.coalesce(F.get("contributors", F.lit(0))["login"], F.lit("")).alias("login")
    return _fetched(spark, d).select("url", "description", "readme_content", login, "fetch_error")


query("fetch_validation", duck.chain("SELECT url, fetch_error IS NULL AS valid, 'graphql_promotion' AS method, fetch_error AS error FROM meta", *_FETCH))(lambda s, d: fetch.as_validation(_fetched(s, d)))


# --- promotion ---


def _enriched(spark: SparkSession, d: str) -> DataFrame:
    return spark_table(spark, d, "enriched")


def _papers(spark: SparkSession, d: str) -> DataFrame:
    return spark_table(spark, d, "papers").select("doi", "title", F.array("author", F.lit("Someone Else")).alias("authors"), "arxiv_id")


def _repos(spark: SparkSession, d: str) -> DataFrame:
    person = F.struct("login", "name", F.lit(None).cast("string").alias("email"))
    return spark_table(spark, d, "repos").select("url", "description", "readme_content", F.array(person).alias("contributors"), "fetch_error")


def same_name():
    """A scorer that needs no model: equal names match."""
    import re

    def score(texts: pd.Series) -> tuple[list[str], list[float]]:
        names = [re.findall(r"<name>(.*)</name>", t) for t in texts]
        return ["match" if a == b else "no-match" for a, b in names], [1.0 if a == b else 0.0 for a, b in names]

    return score


_REPO = "nullif(regexp_extract(url, 'github[.]com/([^/]+)/([^/?#]+)', 2), '')"
_DKEY = duck.sub("lower(doi)", "^https?://(?:dx[.])?doi[.]org/", "", "")
# Each link and DOI with its signals; names and titles are scored once a pair.
_FAST = [
    "enriched", "papers", "repos",
    f"keyed AS (SELECT *, {_DKEY} AS dk, contains(lower(url), 'github.com') AS host FROM enriched)",
    f"item AS (SELECT DISTINCT keyed.url, dk, {_REPO.replace('url', 'keyed.url')} AS repo, papers.doi IS NOT NULL AS has_paper, repos.url IS NOT NULL AS has_data, title, papers.author AS author, arxiv_id, description AS d, readme_content AS r, login, repos.name AS dev, fetch_error FROM keyed LEFT JOIN papers ON dk = papers.doi LEFT JOIN repos ON keyed.url = repos.url WHERE host)",
    f"good AS (SELECT *, {duck.tokens('repo')} AS ta, {duck.tokens('title')} AS tb FROM item WHERE has_paper AND has_data AND fetch_error IS NULL)",
    "gs AS (SELECT *, array_to_string(ta, ' ') AS sa, array_to_string(tb, ' ') AS sb FROM good)",
    f"lp AS (SELECT DISTINCT sa, sb FROM gs)", f"lq AS (SELECT sa, sb, {_FUZZY} AS f FROM lp)",
    f"sc AS (SELECT gs.*, 0.4::DOUBLE * {_CONT} + 0.4::DOUBLE * {_JAC} + 0.2::DOUBLE * f AS s, CASE WHEN coalesce(arxiv_id, '') = '' THEN NULL WHEN list_contains({duck.arxiv_ids('r')}, {duck.arxiv_id('arxiv_id')}) THEN 'readme' WHEN list_contains({duck.arxiv_ids('d')}, {duck.arxiv_id('arxiv_id')}) THEN 'description' END AS loc FROM gs JOIN lq USING (sa, sb))",
]
_SIG = "CASE WHEN loc IS NULL THEN '' ELSE 'arxiv_id_in_' || loc || '|' END || CASE WHEN s >= 0.45 THEN 'name_similarity|' ELSE '' END"
_NFAST = "((loc IS NOT NULL)::INT + (s >= 0.45)::INT)"


def _items(spark: SparkSession, d: str) -> DataFrame:
    r = _enriched(spark, d).withColumn("doi_key", identifiers.paper_doi(c("doi"))).where(F.contains("url", F.lit("github.com"))).select("url", "doi_key").distinct()
    return promote.fast(r.join(promote._papers(_papers(spark, d)), "doi_key").join(promote._repos(_repos(spark, d)), "url").where("fetch_error is null"))


@query("signal_vote", duck.chain(f"SELECT url, dk AS doi, {_SIG} AS signals, {_NFAST} >= 2 AS promoted FROM sc", *_FAST))
def signal_vote(spark, d):
    s = promote.signals(c("arxiv"), c("name"), F.lit(False))
    return _items(spark, d).select("url", c("doi_key").alias("doi"), F.concat_ws("", F.transform(s, lambda x: F.concat(x, F.lit("|")))).alias("signals"), promote.voted(s).alias("promoted"))


query("needs_author_filter", duck.chain(f"SELECT url, dk AS doi FROM sc WHERE {_NFAST} = 1", *_FAST))(lambda s, d: _items(s, d).where(promote.needs_author(c("arxiv"), c("name"))).select("url", c("doi_key").alias("doi")))


@query("author_pairs", duck.chain("SELECT url, dk AS doi, login, unnest([author, 'Someone Else']) AS author FROM sc", *_FAST))
def author_pairs(spark, d):
    return authors.pairs(_items(spark, d).withColumn("doi", c("doi_key"))).select("url", "doi", "login", "author")


@query("classifier_input", duck.chain("SELECT url, dk AS doi, md5('<developer-details>' || n || '    <username>' || login || '</username>' || n || '    <name>' || dev || '</name>' || n || '    <email>None</email>' || n || '</developer-details>' || n || n || '---' || n || n || '<author-details>' || n || '    <name>' || author || '</name>' || n || '</author-details>') AS digest FROM (SELECT * REPLACE (unnest([author, 'Someone Else']) AS author), chr(10) AS n FROM sc)", *_FAST))
def classifier_input(spark, d):
    p = authors.pairs(_items(spark, d).withColumn("doi", c("doi_key")))
    return p.select("url", "doi", F.md5(authors.classifier_input(c("login"), c("name"), c("email"), c("author"))).alias("digest"))


query("author_match", duck.chain("SELECT url, dk AS doi, dev = author AS matched, CASE WHEN dev = author THEN login || '=' || author ELSE '' END AS matches FROM sc", *_FAST))(lambda s, d: authors.matches(_items(s, d).withColumn("doi", c("doi_key")), same_name).select("url", "doi", "matched", F.array_join(F.transform("matches", lambda m: F.concat(m["contributor"], F.lit("="), m["author"])), "|").alias("matches")))

query("author_first_match", duck.chain("SELECT url, dk AS doi, dev = author AS matched, CASE WHEN dev = author THEN login || '=' || author ELSE '' END AS matches FROM sc", *_FAST))(lambda s, d: authors.matches(_items(s, d).withColumn("doi", c("doi_key")), same_name, first_only=True).select("url", "doi", "matched", F.array_join(F.transform("matches", lambda m: F.concat(m["contributor"], F.lit("="), m["author"])), "|").alias("matches")))

_OK_ALL = f"ok AS (SELECT url, dk, {_SIG} || CASE WHEN dev = author THEN 'author_match|' ELSE '' END AS sig, {_NFAST} + (dev = author)::INT >= 2 AS ok FROM sc)"
_OK_SHORT = f"ok AS (SELECT url, dk, {_SIG} || CASE WHEN {_NFAST} = 1 AND dev = author THEN 'author_match|' ELSE '' END AS sig, {_NFAST} + ({_NFAST} = 1 AND dev = author)::INT >= 2 AS ok FROM sc)"


def _joined(col: str) -> Column:
    return F.concat_ws("", F.transform(col, lambda x: F.concat(x, F.lit("|"))))


@query("promote_per_url", duck.chain(f"""SELECT idx, enriched.url, CASE WHEN v.url IS NULL THEN NULL ELSE coalesce(v.ok, false) END AS promoted, CASE WHEN coalesce(v.ok, false) THEN 'isSupplementedBy' ELSE relation END AS relation, CASE WHEN v.url IS NOT NULL THEN relation END AS original_relation, coalesce(v.sig, '') AS signals
FROM enriched LEFT JOIN (SELECT e.url, ok.ok, ok.sig FROM (SELECT * FROM (SELECT url, dk, row_number() OVER (PARTITION BY url ORDER BY idx) AS n FROM keyed WHERE is_valid AND {_REPO} IS NOT NULL AND dk IN (SELECT doi FROM papers)) WHERE n = 1) e LEFT JOIN ok USING (url, dk)) v USING (url)""", *_FAST, _OK_ALL))
def promote_per_url(spark, d):
    p = promote.per_url(_enriched(spark, d), _papers(spark, d), _repos(spark, d), same_name)
    return p.select("idx", "url", "promoted", "relation", "original_relation", F.coalesce(_joined("signals"), F.lit("")).alias("signals"))


_PAIRWISE = f"""SELECT idx, url, CASE WHEN host THEN okr AND skip IS NULL END AS promoted, skip AS skip_reason, CASE WHEN okr AND skip IS NULL THEN 'IsSupplementedBy' ELSE relation END AS relation, CASE WHEN host AND skip IS NULL THEN sig END AS signals FROM (
SELECT *, CASE WHEN NOT host THEN NULL WHEN earlier THEN 'url_already_promoted' WHEN NOT coalesce(has_paper, false) THEN 'no_paper_record' WHEN NOT coalesce(has_data, false) THEN 'no_promotion_data' WHEN fetch_error IS NOT NULL THEN fetch_error WHEN before THEN 'url_already_promoted' END AS skip FROM (
SELECT keyed.idx, keyed.url, keyed.host, keyed.relation, coalesce(ok.ok, false) AS okr, ok.sig, item.has_paper, item.has_data, item.fetch_error,
coalesce(bool_or(coalesce(ok.ok, false)) OVER (PARTITION BY keyed.url ORDER BY keyed.idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS before,
coalesce(bool_or(coalesce(ok.ok, false)) OVER (PARTITION BY keyed.url ORDER BY keyed.idx // 1000 RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS earlier
FROM keyed LEFT JOIN item ON keyed.url = item.url AND keyed.dk = item.dk LEFT JOIN ok ON keyed.url = ok.url AND keyed.dk = ok.dk))"""


@query("promote_first_wins", duck.chain(_PAIRWISE, *_FAST, _OK_SHORT))
def promote_first_wins(spark, d):
    p = promote.per_pair(_enriched(spark, d), _papers(spark, d), _repos(spark, d), same_name)
    return p.select("idx", "url", "promoted", "skip_reason", "relation", F.when(c("signals").isNotNull(), _joined("signals")).alias("signals"))


@query("promote_chunk_reasons", duck.chain(f"SELECT idx // 1000 AS chunk, coalesce(skip_reason, 'judged') AS reason, count(*)::BIGINT AS n FROM ({_PAIRWISE}) WHERE promoted IS NOT NULL GROUP BY 1, 2", *_FAST, _OK_SHORT))
def promote_chunk_reasons(spark, d):
    p = promote.per_pair(_enriched(spark, d), _papers(spark, d), _repos(spark, d), same_name).where("promoted is not null")
    return p.groupBy(F.floor(c("idx") / 1000).alias("chunk"), F.coalesce("skip_reason", F.lit("judged")).alias("reason")).agg(F.count("*").alias("n"))


# --- healing ---

_EOL = r"\r\n|[\n\x0b\f\r\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
_LINES = f"string_split_regex({duck.sub('content', '(?:' + _EOL + ')' + chr(92) + 'z', '', '')}, {duck.lit(_EOL)})"
_L = f"l AS (SELECT doc_id, content, {_LINES} AS l FROM corpus)"
_STRIP = lambda x: duck.sub(x, rf"^{duck.S}+|{duck.S}+\z", "")
query("quality_check", duck.chain(f"""SELECT doc_id, CASE WHEN sp = n THEN 'Empty text' WHEN lg::DOUBLE / len(l) > 0.20 THEN 'Contains ' || lg::VARCHAR || ' extremely long lines (max: ' || mx::VARCHAR || ' chars)' WHEN sp::DOUBLE / n < 0.05 THEN 'Very low whitespace ratio (' || printf('%.1f', sp::DOUBLE / n * 100) || '%) - likely malformed' WHEN n::DOUBLE / len(l) > 1000 THEN 'Unusually long average line length (' || printf('%.0f', n::DOUBLE / len(l)) || ' chars)' ELSE 'OK' END AS quality
FROM (SELECT *, length(content) AS n, length(content) - length({duck.sub('content', duck.S[:-1] + chr(92) + 'x1c-' + chr(92) + 'x1f]', '')}) AS sp, len(list_filter(l, lambda x: length(x) > 1000)) AS lg, list_max(list_transform(l, lambda x: length(x))) AS mx FROM l)""", "corpus", _L))(lambda s, d: corpus(s, d).select("doc_id", healing.quality(c("content")).alias("quality")))
_prepared("dehyphenate", healing.dehyphenate, lambda x: duck.sub(x, rf"([A-Za-z]{{2,}})-{duck.S}*[\r\n]+{duck.S}*([a-z](?:{duck.W}|-)*)", r"\1\2"))
_prepared("bullets", healing.bullets, lambda x: duck.sub(x, rf"(?m)^({duck.S}*)([{healing.BULLETS}]+)({duck.S}*)", r"\1- "))
_prepared("footers", healing.footers, lambda x: duck.sub(duck.sub(x, rf"(?m)^{duck.S}*\p{{Nd}}+{duck.S}*$", ""), rf"(?m)^{duck.S}*(?:Page|Pg\.?){duck.S}*\p{{Nd}}+(?:{duck.S}*of{duck.S}*\p{{Nd}}+)?{duck.S}*$", ""))
query("collapse_blank", duck.chain(rf"SELECT doc_id, md5(t) AS digest, length(t)::BIGINT AS n FROM (SELECT doc_id, regexp_replace(regexp_replace(array_to_string(list_transform(l, lambda x: {duck.sub('x', duck.S + '+' + chr(92) + 'z', '', '')}), chr(10)), '\n{{4,}}', repeat(chr(10), 3), 'g'), '\A\n{{3,}}', repeat(chr(10), 2)) AS t FROM l)", "corpus", _L))(lambda s, d: corpus(s, d).select("doc_id", healing.collapse_blank(c("content")).alias("t")).select("doc_id", F.md5("t").alias("digest"), F.char_length("t").cast("long").alias("n")))
query("fence_balance", duck.chain("SELECT doc_id, (length(content) - length(replace(content, '```', ''))) // 3 % 2 = 1 AS unbalanced FROM corpus", "corpus"))(lambda s, d: corpus(s, d).select("doc_id", healing.unbalanced_fences(c("content")).alias("unbalanced")))
query("repeated_lines", duck.chain(f"""SELECT l.doc_id, coalesce(string_agg(line, '|' ORDER BY line), '') AS lines FROM l LEFT JOIN (SELECT doc_id, line FROM (SELECT doc_id, n, {_STRIP('x')} AS line FROM (SELECT doc_id, len(l) AS n, unnest(l) AS x FROM l)) WHERE length(line) >= 4 AND len(string_split_regex(line, {duck.lit(duck.S + '+')})) <= 12 GROUP BY doc_id, line, n HAVING n >= 50 AND count(*) > 1 AND count(*) >= greatest(1.0::DOUBLE, n / 50.0::DOUBLE) * 0.8::DOUBLE) r USING (doc_id) GROUP BY l.doc_id""", "corpus", _L))(lambda s, d: corpus(s, d).select("doc_id", F.array_join(healing.repeated_lines(c("content")), "|").alias("lines")))
_HEAD = ", ".join(duck.lit(h) for h in healing.HEADINGS)
query("line_kinds", duck.chain(rf"""SELECT doc_id, count(*) FILTER (s <> '' AND length(s) <= 100 AND (lower(s) IN ({_HEAD}) OR regexp_matches(s, '^\d+\.(\d+\.?)?\s+[A-Z]') OR (upper(s) = s AND lower(s) <> s AND length(s) < 50)))::BIGINT AS headers, count(*) FILTER (regexp_matches(s, '[!?]\z') OR (regexp_matches(s, '\.\z') AND length(s) >= 10))::BIGINT AS sentences FROM (SELECT doc_id, trim(unnest(l)) AS s FROM l) GROUP BY doc_id""", "corpus", _L))(lambda s, d: corpus(s, d).select("doc_id", F.explode(healing.text_lines(c("content"))).alias("x")).groupBy("doc_id").agg(F.count_if(healing.section_header(c("x"))).alias("headers"), F.count_if(healing.sentence_end(c("x"))).alias("sentences")))


_SP = duck.S[:-1] + r"\x1c-\x1f]"
_HEADER = rf"(length(s) <= 100 AND (lower(s) IN ({_HEAD}) OR regexp_matches(s, '^\d+\.(\d+\.?)?\s+[A-Z]') OR (upper(s) = s AND lower(s) <> s AND length(s) < 50)))"


def _merge_steps(source: str, lines: str, keep: str) -> list[str]:
    """DuckDB: a fold over the lines of `source`; steps kinds, folded (keep, t). What is carried has the form of a line."""
    code, last = "(x.f OR a.ins)", "right(a.last, 1)"
    shown = f"CASE WHEN {code} AND NOT x.f THEN x.r ELSE x.t END"
    whole = f"(a.plain AND ({last} IN ('!', '?') OR ({last} = '.' AND a.n >= 10)))"
    glue = f"CASE WHEN {code} THEN repeat(chr(10), 1 + least(a.gap, 2)) WHEN a.gap > 1 OR (a.gap = 1 AND (x.b OR x.h OR {whole})) THEN chr(10) || chr(10) WHEN x.b OR NOT a.plain THEN chr(10) WHEN {last} = '-' THEN '' ELSE ' ' END"
    row = lambda **kw: "struct_pack(" + ", ".join(f"{k} := {v}" for k, v in kw.items()) + ")"
    rest = {"r": "''", "f": "false", "b": "false", "h": "false"}
    skipped = row(t="a.t", **rest, ins="a.ins", gap="a.gap + 1", plain="a.plain", last="a.last", n="a.n")
    more = row(t=f"CASE WHEN {glue} = '' THEN left(a.t, length(a.t) - 1) ELSE a.t END || {glue} || {shown}", **rest, ins="a.ins <> x.f", gap="0::BIGINT", plain=f"NOT {code} AND NOT x.b", last=shown,
               n=f"CASE WHEN {glue} = ' ' THEN a.n + 1 + length({shown}) WHEN {glue} = '' THEN a.n - 1 + length({shown}) ELSE length({shown}) END")
    start = row(t="''", **rest, ins="false", gap="0::BIGINT", plain="false", last="''", n="0::BIGINT")
    strip, right = duck.sub("raw", rf"^{_SP}+|{_SP}+\z", ""), duck.sub("raw", rf"{_SP}+\z", "")
    block = duck.lit(rf"^(?:[>#]|(?:\p{{Nd}}+\.|[A-Za-z]\.|[-*+]){_SP})")
    line = row(t="s", r="r", f="starts_with(s, '```')", b=f"regexp_matches(s, {block})", h=f"(s <> '' AND {_HEADER})", ins="false", gap="0::BIGINT", plain="false", last="''", n="0::BIGINT")
    return [
        f"kinds AS (SELECT {keep}, list({line} ORDER BY i) AS ls FROM (SELECT *, {strip} AS s, {right} AS r FROM (SELECT {keep}, unnest({lines}) AS raw, generate_subscripts({lines}, 1) AS i FROM {source})) GROUP BY ALL)",
        f"folded AS (SELECT {keep}, substr(list_reduce(ls, lambda a, x: CASE WHEN NOT {code} AND x.t = '' THEN {skipped} ELSE {more} END, {start}).t, 2) AS t FROM kinds)",
    ]


@query("merge_broken_lines", duck.chain("SELECT doc_id, md5(t) AS digest, length(t)::BIGINT AS n FROM folded", "corpus", _L, *_merge_steps("l", "l", "doc_id")))
def merge_broken_lines(spark, d):
    return corpus(spark, d).select("doc_id", healing.merged(c("content")).alias("t")).select("doc_id", F.md5("t").alias("digest"), F.char_length("t").cast("long").alias("n"))


_LINK = duck.lit("|".join(f"(?:{p})" for p in healing.LINKS).replace(r"\s", r"\s\x0b"))
_foot = lambda x: duck.sub(duck.sub(x, rf"(?m)^{duck.S}*\p{{Nd}}+{duck.S}*$", ""), rf"(?m)^{duck.S}*(?:Page|Pg\.?){duck.S}*\p{{Nd}}+(?:{duck.S}*of{duck.S}*\p{{Nd}}+)?{duck.S}*$", "")
_dehyphen = lambda x: duck.sub(x, rf"([A-Za-z]{{2,}})-{duck.S}*[\r\n]+{duck.S}*([a-z](?:{duck.W}|-)*)", r"\1\2")
_bullet = lambda x: duck.sub(x, rf"(?m)^({duck.S}*)([{healing.BULLETS}]+)({duck.S}*)", r"\1- ")
_of = lambda x: _LINES.replace("content", x)
_HEAL = [
    "corpus",
    f"found AS (SELECT doc_id, content, {_STRIP('content')} = '' AS blank, regexp_extract_all(content, {_LINK}) AS links, string_split_regex(content, {_LINK}) AS parts FROM corpus)",
    "aside AS (SELECT doc_id, content, blank, links, nfc_normalize(array_to_string(list_transform(parts, lambda p, i: p || CASE WHEN i > len(links) THEN '' WHEN list_position(links, links[i]) = i THEN chr(57344) || (i - 1)::VARCHAR || chr(57345) ELSE links[i] END), '')) AS t FROM found WHERE NOT blank)",
    f"rows_of AS (SELECT *, {_of('t')} AS l FROM aside)",
    f"short AS (SELECT *, list_filter(list_transform(l, lambda x: {_STRIP('x')}), lambda x: length(x) >= 4 AND len(string_split_regex(x, {duck.lit(duck.S + '+')})) <= 12) AS s FROM rows_of)",
    "heads AS (SELECT *, CASE WHEN len(l) < 50 OR len(s) = 0 THEN []::VARCHAR[] ELSE list_sort(list_transform(list_filter(map_entries(list_aggregate(s, 'histogram')), lambda e: e.value > 1 AND e.value >= 0.8 * greatest(1.0, len(l) / 50.0)), lambda e: e.key)) END AS gone FROM short)",
    f"bare AS (SELECT *, {_bullet(_dehyphen(_foot('u')))} AS v FROM (SELECT *, CASE WHEN len(gone) > 0 THEN array_to_string(list_filter(l, lambda x: NOT list_contains(gone, {_STRIP('x')})), chr(10)) ELSE t END AS u FROM heads))",
    f"split AS (SELECT doc_id, links, gone, {_of('v')} AS l FROM bare)",
    *_merge_steps("split", "l", "doc_id, links, gone"),
    rf"tidy AS (SELECT doc_id, links, gone, regexp_replace(regexp_replace(array_to_string(list_transform({_of('t')}, lambda x: {duck.sub('x', duck.S + '+' + chr(92) + 'z', '', '')}), chr(10)), '\n{{4,}}', repeat(chr(10), 3), 'g'), '\A\n{{3,}}', repeat(chr(10), 2)) AS t FROM folded)",
    "back AS (SELECT doc_id, gone, array_to_string(list_transform(string_split(t, chr(57344)), lambda p, i: CASE WHEN i = 1 THEN p ELSE links[split_part(p, chr(57345), 1)::INTEGER + 1] || substr(p, strpos(p, chr(57345)) + 1) END), '') AS t FROM tidy)",
    f"state AS (SELECT doc_id, quality FROM ({ORACLES['quality_check']}))",
    """healed AS (SELECT f.doc_id, coalesce(b.t, '') AS t, CASE WHEN f.content = '' THEN '' WHEN f.blank THEN 'Empty input' ELSE array_to_string(list_filter([CASE WHEN q.quality <> 'OK' THEN 'Input quality: ' || q.quality END,
CASE WHEN len(b.gone) > 0 THEN 'Removed repeated lines: ' || array_to_string(b.gone[1:3], ', ') END, CASE WHEN (length(b.t) - length(replace(b.t, '```', ''))) // 3 % 2 = 1 THEN 'Unbalanced code fences' END], lambda x: x IS NOT NULL), '|') END AS warnings
FROM found f JOIN state q USING (doc_id) LEFT JOIN back b USING (doc_id))""",
]


# Texts whose accents were broken in both engines: what comes back is the text as it was.
@query("code_page_mended", duck.chain("SELECT doc_id, md5(content) AS digest, length(content)::BIGINT AS n FROM corpus", "corpus"))
def code_page_mended(spark, d):
    t = corpus(spark, d).select("doc_id", healing.code_page_mended(F.expr(broken("content"))).alias("t"))
    return t.select("doc_id", F.md5("t").alias("digest"), F.char_length("t").cast("long").alias("n"))


@query("heal_text", duck.chain("SELECT doc_id, md5(t) AS digest, length(t)::BIGINT AS n, warnings FROM healed", *_HEAL))
def heal_text(spark, d):
    h = heal_ops.heal_table(corpus(spark, d))
    return h.select("doc_id", F.md5("content").alias("digest"), F.char_length("content").cast("long").alias("n"), F.array_join("healing_warnings", "|").alias("warnings"))


query("heal_stats", duck.chain("SELECT count(*) AS total, count(*) FILTER (warnings = '') AS healed, count(*) FILTER (warnings <> '') AS warnings FROM healed", *_HEAL))(lambda s, d: heal_ops.heal_stats(heal_ops.heal_table(corpus(s, d))))
