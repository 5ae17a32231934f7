"""Text preparation: undoes what PDF extraction does to links.

Two variants: `fulltext` (case-sensitive, 5 domains) and `record` (HTML entities first, 15 domains, any case, any
character in the place of a dot)."""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

# Invisible characters that are removed.
INVISIBLE = "[­​‌‍﻿]"

# Domains that are mended when letter-spaced.
FULLTEXT_DOMAINS = ["github.com", "gitlab.com", "bitbucket.org", "pypi.org", "sourceforge.net"]
RECORD_DOMAINS = [
    "github.com", "gitlab.com", "bitbucket.org", "sourceforge.net", "codeberg.org",
    "pypi.org", "cran.r-project.org", "npmjs.com", "anaconda.org", "rubygems.org",
    "crates.io", "packagist.org", "bioconductor.org", "archive.softwareheritage.org", "codeocean.com",
]


def strip_invisible(c: Column) -> Column:
    return F.regexp_replace(c, INVISIBLE, "")


# Fixed value: the expression.
def join_hyphenated(c: Column) -> Column:
    """The test for a hyphen at a line's end is cheap, and most texts fail it."""
    return _once(c, lambda t: F.when(t.rlike(r"(?U)-\s*\n"), F.regexp_replace(t, r"(?U)(\w)-\s*\n\s*(\w)", "$1$2")).otherwise(t))


# Fixed value: the expression.
def tighten_slashes(c: Column) -> Column:
    """White space goes on both sides of a slash. A run of it is tried from its start only, so that long ones cost their length."""
    return F.regexp_replace(c, r"(?U)(?:(?<!\s)\s++)?/\s*+", "/")


def spaced(domain: str, escape_dot: bool) -> str:
    return r"\s*".join(r"\." if x == "." and escape_dot else x for x in domain)


def _once(c: Column, body) -> Column:
    """body(c) with c evaluated once."""
    return F.get(F.transform(F.array(c), body), 0)


def squeezed(c: Column) -> Column:
    """Without white space, in lower case; the four letters that match i, s and k in any case only are these."""
    return F.lower(F.translate(F.regexp_replace(c, r"(?U)\s+", ""), "\u0130\u0131\u017f\u212a", "iisk"))


def mend_domains(c: Column, domains: list[str] = FULLTEXT_DOMAINS, any_case: bool = False, escape_dot: bool = True) -> Column:
    """Spaces within domain names go. A name is looked for only in texts that hold its longest part once white space is out;
    mending one name makes no part of another."""
    part = lambda d: max(d.split("."), key=len)
    pattern = lambda d: f"(?{'i' if any_case else ''}U){spaced(d, escape_dot)}"
    forms = F.array(*[F.struct(F.lit(part(d)).alias("part"), F.lit(pattern(d)).alias("pattern"), F.lit(d).alias("domain")) for d in domains])
    there = lambda t: _once(squeezed(t), lambda q: F.filter(forms, lambda d: F.contains(q, d["part"])))
    return _once(c, lambda t: F.aggregate(there(t), t, lambda done, d: F.regexp_replace(done, d["pattern"], d["domain"])))


def mend_record_domains(c: Column) -> Column:
    return mend_domains(c, RECORD_DOMAINS, any_case=True, escape_dot=False)


def _literal_map(table: dict[str, str]) -> Column:
    """A map of constants. Strings go in as arrays of one literal each, which keeps the plan small."""
    keys = F.split(F.lit("\x1f".join(table)), "\x1f")
    return F.map_from_arrays(keys, F.split(F.lit("\x1f".join(table.values())), "\x1f"))


def _entity_names() -> str:
    """An expression for the longest name that a text begins with. Names are those of HTML 5, some of them without a
    semicolon; they are grouped by their first letter, so that few are tried."""
    names: dict[str, list[str]] = {}
    for name in sorted(html.entities.html5, key=len, reverse=True):
        names.setdefault(name[0], []).append(name[1:])
    return r"\A(?:" + "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in sorted(names.items())) + ")"


def code_point(n: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def _numbered(digits: Column, base: int) -> Column:
    """What a numeric reference stands for: numbers of the old Western code page stand for its characters, surrogates and
    numbers beyond the last code point for the replacement character, controls and non-characters for nothing."""
    page = {str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)} | {"0": "\ufffd"}
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    n = F.conv(short, base, 10).cast("long")
    control = n.between(1, 8) | n.between(14, 31) | (n == 11) | n.between(0x7F, 0x9F) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    return (
        F.when((F.char_length(short) > 7) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), "\ufffd")
        .when(n.isin(0, *range(0x80, 0xA0)), F.try_element_at(_literal_map(page), n.cast("string"))).when(control, "").otherwise(code_point(n))
    )


def unescape_html(c: Column) -> Column:
    """html.unescape, inside the JVM: what follows each ampersand is a numeric reference, begins with a name, or stays."""
    names, table = _entity_names(), _literal_map(html.entities.html5)

    def after(part: Column) -> Column:
        number = F.regexp_extract(part, r"\A#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
        name = F.regexp_extract(part, names, 0)
        rest = lambda taken: F.substring(part, F.char_length(taken) + 1, F.char_length(part))
        decimal, hexadecimal = F.regexp_extract(number, "#([0-9]+)", 1), F.regexp_extract(number, "[xX]([0-9a-fA-F]+)", 1)
        told = F.when(hexadecimal != "", _numbered(hexadecimal, 16)).otherwise(_numbered(decimal, 10))
        return F.when(number != "", F.concat(told, rest(number))).when(name != "", F.concat(F.try_element_at(table, name), rest(name))).otherwise(F.concat(F.lit("&"), part))

    parts = F.split(c, "&")
    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(after(p))), "")).otherwise(c)


def prepare_fulltext(c: Column) -> Column:
    return mend_domains(tighten_slashes(join_hyphenated(strip_invisible(c))))


def prepare_record(c: Column, unescape: bool = True) -> Column:
    return mend_record_domains(tighten_slashes(join_hyphenated(strip_invisible(unescape_html(c) if unescape else c))))
