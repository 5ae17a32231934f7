"""Links to code hosts, package registries and software archives: patterns, exclusion, canonical forms, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Link patterns of the fulltext path, in the order in which they are tried.
_TAIL = r"""(?:/[^\s)"'<>]*)?"""
_REPO = r"[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+"
FULLTEXT = {
    "github": rf"(?:https?://)?(?:www\.)?github\.com/{_REPO}{_TAIL}",
    "gitlab": rf"(?:https?://)?(?:www\.)?gitlab\.com/{_REPO}{_TAIL}",
    "bitbucket": rf"(?:https?://)?(?:www\.)?bitbucket\.org/{_REPO}{_TAIL}",
    "sourceforge": r"(?:https?://)?(?:www\.)?sourceforge\.net/projects/[a-zA-Z0-9_-]+",
    "codeberg": rf"(?:https?://)?(?:www\.)?codeberg\.org/{_REPO}{_TAIL}",
    "pypi": r"(?:https?://)?pypi\.org/project/[a-zA-Z0-9_-]+",
    "cran": r"(?:https?://)?cran\.r-project\.org/package=[a-zA-Z0-9_.]+",
    "npm": r"(?:https?://)?(?:www\.)?npmjs\.com/package/[a-zA-Z0-9@/._-]+",
    "conda": rf"(?:https?://)?anaconda\.org/{_REPO}",
    "rubygems": r"(?:https?://)?rubygems\.org/gems/[a-zA-Z0-9_-]+",
    "cargo": r"(?:https?://)?crates\.io/crates/[a-zA-Z0-9_-]+",
    "packagist": r"(?:https?://)?packagist\.org/packages/[a-zA-Z0-9_-]+/[a-zA-Z0-9_-]+",
    "bioconductor": r"(?:https?://)?bioconductor\.org/packages/[a-zA-Z0-9_.]+",
    "software_heritage": r"""(?:https?://)?archive\.softwareheritage\.org/[^\s)"'<>]+""",
    "codeocean": r"(?:https?://)?codeocean\.com/capsule/[a-zA-Z0-9_-]+",
}
# A text without this string has no link of the type.
LITERAL = {
    "github": "github.com/", "gitlab": "gitlab.com/", "bitbucket": "bitbucket.org/", "sourceforge": "sourceforge.net/", "codeberg": "codeberg.org/",
    "pypi": "pypi.org/", "cran": "cran.r-project.org/", "npm": "npmjs.com/", "conda": "anaconda.org/", "rubygems": "rubygems.org/", "cargo": "crates.io/",
    "packagist": "packagist.org/", "bioconductor": "bioconductor.org/", "software_heritage": "archive.softwareheritage.org/", "codeocean": "codeocean.com/",
}
# Link patterns of the record path, in order; group 1 is what the canonical form keeps.
RECORD = {
    "pypi": r"(?:https?://)?pypi\.org/project/([a-zA-Z0-9_-]+)",
    "cran": r"(?:https?://)?cran\.r-project\.org/package=([a-zA-Z0-9_.]+)",
    "npm": r"(?:https?://)?(?:www\.)?npmjs\.com/package/([a-zA-Z0-9@/._-]+)",
    "conda": rf"(?:https?://)?anaconda\.org/({_REPO})",
    "rubygems": r"(?:https?://)?rubygems\.org/gems/([a-zA-Z0-9_-]+)",
    "cargo": r"(?:https?://)?crates\.io/crates/([a-zA-Z0-9_-]+)",
    "packagist": r"(?:https?://)?packagist\.org/packages/([a-zA-Z0-9_-]+/[a-zA-Z0-9_-]+)",
    "bioconductor": r"(?:https?://)?bioconductor\.org/packages/([a-zA-Z0-9_.]+)",
    "github": rf"(?:https?://)?(?:www\.)?github\.com/({_REPO}){_TAIL}",
    "gitlab": rf"(?:https?://)?(?:www\.)?gitlab\.com/({_REPO}){_TAIL}",
    "bitbucket": rf"(?:https?://)?(?:www\.)?bitbucket\.org/({_REPO}){_TAIL}",
    "sourceforge": r"(?:https?://)?(?:www\.)?sourceforge\.net/projects/([a-zA-Z0-9_-]+)",
    "codeberg": rf"(?:https?://)?codeberg\.org/({_REPO}){_TAIL}",
    "software_heritage": r"""(?:https?://)?archive\.softwareheritage\.org/([^\s)"'<>]+)""",
    "codeocean": r"(?:https?://)?codeocean\.com/capsule/([a-zA-Z0-9_-]+)",
}
# Path words of pages that are no repository, and extensions of data files.
EXCLUDED_WORDS = ["wiki", "issues", "pull", "pulls", "discussions", "projects", "actions", "security", "pulse", "graphs", "settings", "stargazers", "watchers", "network", "forks"]
DATA_EXTENSIONS = ["csv", "json", "xml", "xlsx", "xls", "tsv", "dat", "txt", "md", "rst", "pdf", "doc", "docx", "png", "jpg", "jpeg", "gif", "svg", "bmp", "zip", "tar", "gz", "rar", "7z"]
CODE_HOSTS = ["github", "gitlab", "bitbucket", "codeberg"]
PACKAGES = ["pypi", "cran", "npm", "conda", "rubygems", "cargo", "packagist", "bioconductor"]
ARCHIVES = ["software_heritage", "codeocean"]
# Canonical prefixes of the record path.
CANONICAL = {
    "pypi": "https://pypi.org/project/", "cran": "https://cran.r-project.org/package=", "npm": "https://www.npmjs.com/package/", "conda": "https://anaconda.org/",
    "rubygems": "https://rubygems.org/gems/", "cargo": "https://crates.io/crates/", "packagist": "https://packagist.org/packages/", "bioconductor": "https://bioconductor.org/packages/",
    "github": "https://github.com/", "gitlab": "https://gitlab.com/", "bitbucket": "https://bitbucket.org/", "codeberg": "https://codeberg.org/", "sourceforge": "https://sourceforge.net/projects/",
}

# What is no link to code, and what may trail a link. In the record path a site's pages need no test of their own:
# a hit there begins with the code host's name, and a site's name stands before it.
EXCLUDED_PATH = rf"/(?:{'|'.join(EXCLUDED_WORDS)})(?:/|\z)"
DATA_FILE = rf"\.(?:{'|'.join(DATA_EXTENSIONS)})\z"
PAGES_SITE = r"[a-zA-Z0-9_-]+\.github\.io/"
TRAILING = r"""[).,;:!?"'>\]]+\z"""


def all_links(text: Column, patterns: dict[str, str] | None = None) -> Column:
    """array of (pattern_idx, pos, url, type), in pattern order and then text order. A pattern runs only over texts that
    hold its host."""
    def group(i: int, name: str, pattern: str) -> Column:
        found = F.when(F.contains(text, F.lit(LITERAL[name])), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        hit = lambda url, pos: F.struct(F.lit(i).alias("pattern_idx"), pos.alias("pos"), url.alias("url"), F.lit(name).alias("type"))
        return F.transform(F.coalesce(found, F.array().cast("array<string>")), hit)

    return F.flatten(F.array(*[group(i, *x) for i, x in enumerate((patterns or FULLTEXT).items())]))


def kept(url: Column) -> Column:
    """The fulltext exclusion filter, on links as found."""
    return ~url.rlike(PAGES_SITE) & ~url.rlike(EXCLUDED_PATH) & ~(url.rlike("/(?:blob|raw)/") & url.rlike(DATA_FILE))


def bare(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, "^https?://", ""), r"^www\.", "")


def normalised(url: Column, kind: Column) -> Column:
    """The fulltext normal form; null where a code host's link has no owner and repository."""
    c = F.regexp_replace(bare(url), TRAILING, "")
    c = F.when(kind.isin(CODE_HOSTS), F.nullif(F.regexp_extract(c, "^([^/]+/[^/]+/[^/]+)", 1), F.lit(""))).otherwise(c)
    c = F.regexp_replace(F.regexp_replace(c, r"\.git\z", ""), TRAILING, "")
    return F.concat(F.lit("https://"), c)


def dedup_key(url: Column) -> Column:
    return F.lower(bare(url))


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, r"[^A-Za-z0-9_-]+\z", "")


def _prefix(kind: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in CANONICAL.items() for x in kv]), kind)


def package_canonical(kind: Column, name: Column) -> Column:
    return F.when(kind.isin(PACKAGES), F.concat(_prefix(kind), F.nullif(trimmed(name), F.lit(""))))


def record_excluded(link: Column) -> Column:
    low = F.lower(link)
    words = F.arrays_overlap(F.split(low, "/"), F.array(*[F.lit(w) for w in EXCLUDED_WORDS]))
    return words | (low.rlike("/(?:blob|raw)/") & low.rlike(DATA_FILE))


def repo_canonical(kind: Column, link: Column, path: Column) -> Column:
    """Owner and repository after the host; links with fewer parts, or to other pages, are dropped."""

    def of(parts: Column) -> Column:
        user, repo = F.nullif(trimmed(F.get(parts, 0)), F.lit("")), F.nullif(F.regexp_replace(trimmed(F.get(parts, 1)), r"\.git\z", ""), F.lit(""))
        return F.when(kind == "sourceforge", F.when(repo.isNotNull(), F.concat(_prefix(kind), user))).otherwise(F.concat(_prefix(kind), user, F.lit("/"), repo))

    return F.when(kind.isin([*CODE_HOSTS, "sourceforge"]) & ~record_excluded(link), F.element_at(F.transform(F.array(F.split(trimmed(path), "/")), of), 1))


def archive_canonical(link: Column) -> Column:
    u = F.nullif(trimmed(link), F.lit(""))
    return F.replace(F.when(u.startswith("http"), u).otherwise(F.concat(F.lit("https://"), u)), F.lit("http://"), F.lit("https://"))


def canonical(kind: Column, link: Column, group: Column) -> Column:
    """The record path's canonical form, null where the link is dropped."""
    return F.coalesce(package_canonical(kind, group), F.when(kind.isin(ARCHIVES), archive_canonical(link)), repo_canonical(kind, link, group))


def base_key(url: Column) -> Column:
    """The record path's key of a repository or package."""
    # Registries whose key starts at their prefix, and hosts with keys of three parts.
    registries = [r"pypi\.org/project/", r"cran\.r-project\.org/package=", r"npmjs\.com/package/", r"crates\.io/crates/"]
    hosts = r"^(?:github\.com|gitlab\.com|bitbucket\.org|codeberg\.org|sourceforge\.net/projects/)"
    first = lambda c: F.array_join(F.slice(F.split(c, "/"), 1, 3), "/")

    def of(u: Column) -> Column:
        cut = F.coalesce(*[F.nullif(F.regexp_extract(u, f"(?s)({p}.*)", 1), F.lit("")) for p in registries])
        return F.when(u.rlike(hosts), first(u)).otherwise(F.coalesce(first(cut), u))

    return F.element_at(F.transform(F.array(F.regexp_replace(bare(F.lower(url)), r"/+\z", "")), of), 1)


def category(url: Column) -> Column:
    """Kind of host, by the first of these that the link holds."""
    low = F.lower(url)
    # In this order.
    table = [
        ("github.com", "github"), ("gitlab", "gitlab"), ("bitbucket", "bitbucket"), ("codeberg.org", "codeberg"), ("pypi.org", "pypi"), ("npmjs.com", "npm"), ("cran.r-project.org", "cran"),
        ("bioconductor.org", "bioconductor"), ("zenodo.org", "zenodo"), ("figshare.com", "figshare"), ("codeocean.com", "codeocean"), ("softwareheritage.org", "software_heritage"),
    ]
    out = F.lit("other")
    for part, kind in reversed(table):
        out = F.when(F.contains(low, F.lit(part)), F.lit(kind)).otherwise(out)
    return out


def repo_parts(url: Column) -> tuple[Column, Column]:
    """Owner and repository of a code-host link, null if there are none."""
    p = r"github\.com/([^/]+)/([^/?#]+)"
    return F.nullif(F.regexp_extract(url, p, 1), F.lit("")), F.nullif(F.regexp_replace(F.regexp_extract(url, p, 2), r"\.git\z", ""), F.lit(""))


def check_url(url: Column, kind: Column) -> Column:
    """What an HTTP check asks for, null where the link has no package."""
    # Where a registry answers.
    take = lambda p: F.nullif(F.regexp_extract(url, p, 1), F.lit(""))
    return (
        F.when(kind == "pypi", F.concat(F.lit("https://pypi.org/pypi/"), take(r"pypi\.org/project/([^/]+)"), F.lit("/json")))
        .when(kind == "npm", F.concat(F.lit("https://registry.npmjs.org/"), take(r"npmjs\.com/package/([^/]+)")))
        .when(kind == "cran", F.concat(F.lit("https://cran.r-project.org/package="), take(r"cran\.r-project\.org/(?:web/)?package[s]?[=/]([^/&]+)")))
        .when(kind == "bioconductor", F.concat(F.lit("https://bioconductor.org/packages/"), take(r"bioconductor\.org/packages/(?:release/|devel/)?(?:bioc|data|workflows)?/?([^/]+)")))
        .when(kind.isin("zenodo", "figshare", "codeocean", "software_heritage"), url)
    )
