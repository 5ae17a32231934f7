"""Repair of texts: literal cases, and the steps against plain versions."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from gleaner.functions import healing, textprep
from gleaner.operators import healing as heal_ops

TEXT = "Head line\n" * 60 + "trans-\nformer exam-\nple\n• one\n12\nPage 3 of 4\nbroken\nline. see https://github.com/a/b\n```\ncode  \n"


def healed(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [(r.t, r.w) for r in healing.healed(df, "t", "w").orderBy("i").collect()]


def test_whole_repair(spark):
    (text, warnings), blank, null = healed(spark, TEXT, " \n ", None)
    assert "transformer" in text and "- one" in text and "broken line. see https://github.com/a/b" in text and "Head line" not in text
    assert "Page 3" not in text and warnings == ["Removed repeated lines: Head line", "Unbalanced code fences"]
    assert blank == null == ("", ["Empty input"])


def test_table_repair_and_its_counts(spark):
    df = spark.createDataFrame([(1, TEXT, "x"), (2, "", "y"), (3, None, "z"), (4, "Fine text, it is.", "w")], "k int, content string, more string")
    out = heal_ops.heal_table(df)
    rows = {r.k: r for r in out.collect()}
    assert rows[2].content == rows[3].content == "" and rows[3].healing_warnings == [] and rows[4].content == "Fine text, it is." and rows[1].more == "x"
    assert heal_ops.heal_stats(out).first().asDict() == {"total": 4, "healed": 3, "warnings": 1}


@pytest.mark.parametrize(
    "text, want",
    [
        ("one\ntwo", "one two"),
        ("hyphen-\nated", "hyphenated"),
        ("one\n\ntwo", "one two"),
        ("A sentence ends.\n\nNext", "A sentence ends.\n\nNext"),
        ("No. 1.\n\nNext", "No. 1. Next"),
        ("Why?\n\nNext", "Why?\n\nNext"),
        ("one\n\n\n\ntwo", "one\n\ntwo"),
        ("text\n\nIntroduction\ngoes on", "text\n\nIntroduction goes on"),
        ("text\n- a\n- b\nplain", "text\n- a\n- b\nplain"),
        ("text\n\n> quote", "text\n\n> quote"),
        ("text\n# Head\n1. item", "text\n# Head\n1. item"),
        ("a\n\n\n\n```\n  x  \n\ny\n```\nb\nc", "a\n\n\n```\n  x\n\ny\n```\nb c"),
        ("", ""),
    ],
)
def test_broken_lines(spark, text, want):
    assert plain_merge(text) == want
    assert spark.createDataFrame([(text,)], "t string").select(healing.merged(F.col("t"))).first()[0] == want


def plain_merge(text):
    """The joining of lines, line by line."""
    out, inside, last, before, length = "", False, -1, None, 0
    for i, raw in enumerate(text.splitlines()):
        s = raw.strip()
        fence = s.startswith("```")
        code = fence or inside
        block = re.match(r"[>#]|(?:\d+\.|[A-Za-z]\.|[-*+])\s", s) is not None
        if not code and not s:
            continue
        shown = raw.rstrip() if code and not fence else s
        gap, last, inside = i - last - 1, i, inside ^ fence
        header = len(s) <= 100 and (s.lower() in healing.HEADINGS or re.match(r"\d+\.(\d+\.?)?\s+[A-Z]", s) is not None or (s.isupper() and len(s) < 50))
        plain = before is not None and before[1]
        whole = plain and (before[0][-1] in "!?" or (before[0][-1] == "." and length >= 10))
        if code:
            glue = "\n" * (1 + min(gap, 2))
        elif gap > 1 or (gap and (block or header or whole)):
            glue = "\n\n"
        elif block or not plain:
            glue = "\n"
        else:
            glue = "" if before[0].endswith("-") else " "
        if glue == "":
            out, length = out[:-1], length - 1
        length = len(shown) + (length + len(glue) if glue in ("", " ") else 0)
        out += glue + shown
        before = (shown, not code and not block)
    return out[1:]


def test_joining_equals_the_plain_loop(spark, monkeypatch):
    rng = random.Random(5)
    pieces = ["\n", "\n", "\n", "\n\n", " ", "\t", "a.", "Done now, it is.", "why?", "in-", "word", "```", "  code  x", "- item", "1. one", "# head", "> q", "ABC", "Introduction", "2.1 Xy", "é", "\r\n", "\x1f", "\u2028", "b.", "-"]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", "\n"]) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for fold in (256, 3):
        monkeypatch.setattr(healing, "FOLD", fold)
        for r in df.select("t", healing.merged(F.col("t")).alias("x")).collect():
            assert r.x == plain_merge(r.t), r.t
    assert spark.range(1).select(healing.merged(F.lit(None).cast("string"))).first()[0] is None


def test_many_lines_are_joined(spark):
    text = "a line of a long text\n" * 100_000
    df = spark.createDataFrame([(text,)], "t string")
    df.limit(1).select(F.char_length(healing.merged(F.lit("x\ny")))).collect()
    began = time.time()
    assert df.select(F.char_length(healing.merged(F.col("t")))).first()[0] == len(text) - 1
    assert time.time() - began < 20


def test_links_are_set_aside_once_and_put_back(spark):
    rng = random.Random(4)
    pieces = ["https://a.org/x-", "github.com/u/r", "plain", "\n", " ", "b.io/p", "(", "x\ue000y", "https://a.org/x-"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("s", healing.set_aside(F.col("t")))
    for r in df.select("t", "s", healing.put_back(F.col("s.text"), F.col("s.links")).alias("back")).collect():
        assert r.back == r.t.replace("\ue000", "")
        assert r.s.text.count(healing.OPEN) == len(set(r.s.links))


def test_entities_equal_the_library(spark):
    """Names with and without a semicolon, longest first; numbers of all kinds; what is none stays."""
    import html
    from html.entities import html5

    rng = random.Random(3)
    names = list(html5)
    bits = ["&", "&#", "&#x", ";", "amp", "lt", "notit", "copy", "9", "0", "65", "1F600", "d800", "110000", "99999999999", "80", "81", "xA0", " ", "é", "fffe", "b", "1", "-", "&&", "\n"]
    texts = ["".join(rng.choice(bits) if rng.random() < 0.7 else "&" + rng.choice(names) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    texts += ["&" + n for n in names] + [f"&#{n};" for n in [*range(0, 260), 0xFDD0, 0xFFFE, 0x1FFFF, 0x10FFFF, 0x110000, 0xD800]] + [f"&#x{n:x}" for n in range(0, 170)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", textprep.unescape_html(F.col("t")).alias("u")).collect():
        assert r.u == html.unescape(r.t), r.t
    plan = df.select(textprep.prepare_record(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "MapIn" not in plan


def test_texts_without_an_ampersand_stay(spark):
    df = spark.createDataFrame([("a &amp; b",), ("plain",), (None,)], "t string")
    assert [r.u for r in df.select(textprep.unescape_html(F.col("t")).alias("u")).collect()] == ["a & b", "plain", None]


#: The steps as plain expressions, which take the square of a run of white space.
PLAIN = {
    "footers": lambda t: re.sub(r"^\s*(?:Page|Pg\.?)\s*\d+(?:\s*of\s*\d+)?\s*$", "", re.sub(r"^\s*\d+\s*$", "", t, flags=re.M), flags=re.M),
    "bullets": lambda t: re.sub(r"^(\s*)([•●◦▪▫·]+)(\s*)", r"\1- ", t, flags=re.M),
    "dehyphenate": lambda t: re.sub(r"([A-Za-z]{2,})-\s*[\r\n]+\s*([a-z][\w-]*)", r"\1\2", t),
    "stripped": lambda t: re.sub(r"^\s+|\s+\Z", "", t),
}


@pytest.mark.parametrize("name", sorted(PLAIN))
def test_linear_steps_equal_the_plain_expressions(spark, name):
    rng = random.Random(8)
    pieces = ["\n", "\n", " ", "\t", "\r", "1", "23", "Page 3", "Pg. 4 of 9", "of 5", "•", "▪▪", "ab-", "cd", "é", "X", "-", "a"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", getattr(healing, name)(F.col("t")).alias("x")).collect():
        assert r.x == PLAIN[name](r.t), r.t


def test_a_megabyte_of_white_space(spark):
    """A text, its blanks or line ends in the middle: each of the steps in seconds, where the plain expressions take hours."""
    for run in (" ", "\n", "\n \t"):
        df = spark.createDataFrame([("start" + run * (1_000_000 // len(run)) + "end - of it",)], "t string")
        df.select(healing.footers(F.col("t"))).collect()
        began = time.time()
        for step in (healing.stripped, healing.collapse_blank, healing.footers, healing.bullets, healing.dehyphenate):
            df.select(F.char_length(step(F.col("t")))).collect()
        df.select(F.size(healing.repeated_lines(F.col("t")))).collect()
        assert time.time() - began < 12
        began = time.time()
        assert healing.healed(df, "t", "w").select("t").first().t.split() == ["start", "end", "-", "of", "it"]
        assert time.time() - began < 15


def test_links_are_not_mended(spark):
    """A link with a character that is not in composed form stays; the text around it is composed."""
    text = "cafe\u0301 https://a.org/cafe\u0301 done"
    assert healed(spark, text)[0][0] == "caf\u00e9 https://a.org/cafe\u0301 done"


@pytest.mark.parametrize("page", ["cp1252", "latin-1"])
def test_texts_read_by_the_wrong_code_page(spark, page):
    good = ["café", "El Niño está aquí, señor", "naïve façade", "“quoted” – it’s 5 € …", "10 °C ± 2", "straße über Öl", "smile 😀 end", "中文文本", "Привет мир", "\ufeffstart", "a\u00a0b", "ﬁnd", "Łódź żółw ž"]

    def misread(text):
        return "".join(bytes([b]).decode(page) if page == "latin-1" or b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in text.encode())

    bad = [misread(t) for t in good]
    mixed = [f"café {bad[0]} Ã"]
    rows = spark.createDataFrame([(t,) for t in bad + mixed], "t string").select(healing.code_page_mended(F.col("t"))).collect()
    skip = {"straße über Öl"} if page == "latin-1" else set()
    assert [r[0] for r, g in zip(rows, good, strict=False) if g not in skip] == [g for g in good if g not in skip]
    assert rows[-1][0] == "café café Ã"


def test_clean_texts_keep_their_characters(spark):
    clean = ["café", "il dit « oui » à\u00a0« midi »", "é…” dit-il", "AMANHÃ… PÅ” Ü…", "Ñandú® à® São Paulo™", "中文 Привет", "", "plain", None, "ÉÈ©", "x" * 100000 + "é", "Â", "å—ß"]
    df = spark.createDataFrame([(t,) for t in clean], "t string")
    assert [r[0] for r in df.select(healing.code_page_mended(F.col("t"))).collect()] == clean
    bad = "caf\u00c3\u00a9 https://example.org/\u00c3\u00a9 e\u0301"
    one = spark.createDataFrame([(bad,)], "t string")
    assert healing.healed(one, "t", "w").first()["t"] == "café https://example.org/\u00c3\u00a9 é"
