"""DuckDB SQL for the oracles: the steps as common table expressions, with Unicode classes spelled out where the other
engine has a flag."""

from __future__ import annotations

from ..functions import links, similarity, textprep
from .inputs import duck_table

S = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
W = r"[\p{L}\p{M}\p{N}_]"


def lit(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def sub(c: str, pattern: str, by: str, flags: str = "g") -> str:
    return f"regexp_replace({c}, {lit(pattern)}, {lit(by)}, {lit(flags)})"


def invisible(c: str) -> str:
    return sub(c, r"[\x{AD}\x{200B}\x{200C}\x{200D}\x{FEFF}]", "")


def hyphen(c: str) -> str:
    return sub(c, rf"({W})-{S}*\n{S}*({W})", r"\1\2")


def slash(c: str) -> str:
    return sub(c, rf"{S}*/{S}*", "/")


def domains(c: str, names=textprep.FULLTEXT_DOMAINS, flags: str = "g", escape: bool = True) -> str:
    for d in names:
        c = sub(c, rf"{S}*".join(r"\." if x == "." and escape else x for x in d), d, flags)
    return c


def fulltext(c: str) -> str:
    return domains(slash(hyphen(invisible(c))))


def record(c: str) -> str:
    return domains(slash(hyphen(invisible(f"replace({c}, '&amp;', '&')"))), textprep.RECORD_DOMAINS, "gi", False)


def hits(names: list[str] | None = None) -> str:
    parts = [f"SELECT id AS doc_id, {i} AS pattern_idx, unnest(range(len(h))) AS pos, unnest(h) AS url, {lit(n)} AS type FROM (SELECT id, regexp_extract_all(t, {lit(p)}) AS h FROM prep)" for i, (n, p) in enumerate(links.FULLTEXT.items()) if names is None or n in names]
    return "hits AS (" + " UNION ALL ".join(parts) + ")"


PREP = f"prep AS (SELECT doc_id, id, {fulltext('content')} AS t FROM corpus)"
M = lambda c, p: f"regexp_matches({c}, {lit(p)})"
KEPT = f"kept AS (SELECT * FROM hits WHERE NOT {M('url', links.PAGES_SITE)} AND NOT {M('url', links.EXCLUDED_PATH)} AND NOT ({M('url', '/(?:blob|raw)/')} AND {M('url', links.DATA_FILE)}))"
BARE = lambda c: sub(sub(c, "^https?://", "", ""), r"^www\.", "", "")
_host = "type IN ('github', 'gitlab', 'bitbucket', 'codeberg')"
NORMED = f"""normed AS (SELECT doc_id, pattern_idx, pos, type, 'https://' || {sub(sub("c", r"[.]git" + chr(92) + "z", "", ""), links.TRAILING, "", "")} AS url FROM (
  SELECT *, CASE WHEN {_host} THEN nullif(regexp_extract(b, '^([^/]+/[^/]+/[^/]+)', 1), '') ELSE b END AS c FROM (SELECT *, {sub(BARE("url"), links.TRAILING, "", "")} AS b FROM kept)))"""
FIRST = f"first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, lower({BARE('url')}) ORDER BY pattern_idx, pos, url) AS n FROM normed) WHERE n = 1)"


def chain(select: str, *steps: str) -> str:
    """steps: names of input tables, or common table expressions."""
    return "WITH RECURSIVE " + ",\n".join(duck_table(s) if " " not in s else s for s in steps) + "\n" + select


FOUND = ("corpus", PREP, hits(), KEPT, NORMED, FIRST)


def trimmed(c: str) -> str:
    return sub(c, r"[^A-Za-z0-9_-]+\z", "", "")


def record_hits() -> str:
    parts = [f"SELECT doc_id, rec_id, {i} AS pattern_idx, unnest(range(len(a))) AS pos, unnest(a) AS link, unnest(b) AS grp, {lit(n)} AS type FROM (SELECT doc_id, rec_id, regexp_extract_all(t, {lit('(?i)' + p)}, 0) AS a, regexp_extract_all(t, {lit('(?i)' + p)}, 1) AS b FROM rprep)" for i, (n, p) in enumerate(links.RECORD.items())]
    return "rhits AS (" + " UNION ALL ".join(parts) + ")"


RPREP = f"rprep AS (SELECT doc_id, rec_id, {record('text')} AS t FROM records)"
RPREP_WANTED = f"rprep AS (SELECT doc_id, rec_id, {record('text')} AS t FROM records WHERE kind IN ('Abstract', 'Other') AND text <> '')"


def canonical() -> str:
    n = f"nullif({trimmed('grp')}, '')"
    cases = [f"WHEN type = {lit(k)} THEN {lit(links.CANONICAL[k])} || {n}" for k in links.PACKAGES]
    words = ", ".join(lit(w) for w in links.EXCLUDED_WORDS)
    excluded = f"(len(list_intersect(string_split(lower(link), '/'), [{words}])) > 0 OR ({M('lower(link)', '/(?:blob|raw)/')} AND {M('lower(link)', links.DATA_FILE)}))"
    user = trimmed(f"string_split({trimmed('grp')}, '/')[1]")
    repo = sub(trimmed(f"string_split({trimmed('grp')}, '/')[2]"), r"\.git\z", "", "")
    fine = f"NOT {excluded} AND len(string_split({trimmed('grp')}, '/')) >= 2 AND {user} <> '' AND {repo} <> ''"
    for k in links.CODE_HOSTS:
        cases.append(f"WHEN type = {lit(k)} AND {fine} THEN {lit(links.CANONICAL[k])} || {user} || '/' || {repo}")
    u = f"nullif({trimmed('link')}, '')"
    cases.append(f"WHEN type IN ('software_heritage', 'codeocean') THEN replace(CASE WHEN starts_with({u}, 'http') THEN {u} ELSE 'https://' || {u} END, 'http://', 'https://')")
    return "CASE " + " ".join(cases) + " END"


def base_key(c: str) -> str:
    u = sub(BARE(f"lower({c})"), r"/+\z", "", "")
    first = lambda x: f"array_to_string(string_split({x}, '/')[1:3], '/')"
    cut = "coalesce(" + ", ".join(f"nullif(regexp_extract({u}, {lit('(' + p + '.*)')}, 1), '')" for p in (r"pypi\.org/project/", r"cran\.r-project\.org/package=", r"npmjs\.com/package/", r"crates\.io/crates/")) + ")"
    host = M(u, r"^(?:github\.com|gitlab\.com|bitbucket\.org|codeberg\.org|sourceforge\.net/projects/)")
    return f"CASE WHEN {host} THEN {first(u)} WHEN {cut} IS NOT NULL THEN {first(cut)} ELSE {u} END"


RNAMED = f"rnamed AS (SELECT *, {base_key('url')} AS base FROM (SELECT *, {canonical()} AS url FROM rhits) WHERE url IS NOT NULL AND url <> '')"
RFIRST = "rfirst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rec_id, doc_id, base ORDER BY pattern_idx, pos) AS n FROM rnamed) WHERE n = 1)"


def category(c: str) -> str:
    pairs = [("github.com", "github"), ("gitlab", "gitlab"), ("bitbucket", "bitbucket"), ("codeberg.org", "codeberg"), ("pypi.org", "pypi"), ("npmjs.com", "npm"), ("cran.r-project.org", "cran"), ("bioconductor.org", "bioconductor"), ("zenodo.org", "zenodo"), ("figshare.com", "figshare"), ("codeocean.com", "codeocean"), ("softwareheritage.org", "software_heritage")]
    return "CASE " + " ".join(f"WHEN contains(lower({c}), {lit(a)}) THEN {lit(b)}" for a, b in pairs) + " ELSE 'other' END"


def tokens(c: str) -> str:
    t = sub(f"translate(lower(coalesce({c}, '')), '-_', '  ')", r"""[!"#$%&'()*+,./:;<=>?@\[\\\]^`{|}~]""", "")
    stop = ", ".join(lit(w) for w in ["", *similarity.STOPWORDS])
    return f"list_sort(list_filter(list_distinct(string_split_regex({t}, {lit(S + '+')})), lambda w: NOT list_contains([{stop}], w)))"


def lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence of two strings, rows folded over a."""
    row = f"list_reduce(string_split({b}, ''), lambda r, y: list_append(r, CASE WHEN x = y THEN coalesce(p[len(r)], 0) + 1 ELSE greatest(p[len(r) + 1], coalesce(r[len(r)], 0)) END), []::INT[])"
    return f"list_last(list_reduce(string_split({a}, ''), lambda p, x: {row}, list_transform(string_split({b}, ''), lambda z: 0)))"


ARXIV = [r"(?i)10\.48550/arXiv\.(\d{4}\.\d{4,5})", r"(?i)arxiv\.org/abs/(\d{4}\.\d{4,5})", r"(?i)arxiv\.org/abs/([a-z-]+/\d{7})", r"\b(\d{4}\.\d{4,5})(?:v\d+)?\b", r"(?i)\b([a-z-]+/\d{7})\b"]


def arxiv_id(c: str) -> str:
    a = f"CASE WHEN starts_with({c}, '10.48550') THEN coalesce(nullif(regexp_extract({c}, '(?i)arXiv\\.(\\d{{4}}\\.\\d{{4,5}})', 1), ''), {c}) ELSE {c} END"
    b = f"CASE WHEN contains(lower({a}), 'arxiv.org') THEN coalesce(nullif(regexp_extract({a}, '(?i)abs/(\\d{{4}}\\.\\d{{4,5}}|[a-z-]+/\\d{{7}})', 1), ''), {a}) ELSE {a} END"
    v = sub(f"({b})", r"v\d+$", "", "")
    return f"CASE WHEN contains({v}, '/') THEN lower({v}) ELSE {v} END"


def arxiv_ids(c: str) -> str:
    found = " || ".join(f"regexp_extract_all(coalesce({c}, ''), {lit(p)}, 1)" for p in ARXIV)
    return f"list_distinct(list_transform({found}, lambda v: {arxiv_id('v')}))"
