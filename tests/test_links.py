"""Extraction, filtering, normal forms, keys and deduplication on literal cases."""

import pytest
from pyspark.sql import functions as F

from gleaner.functions import identifiers, links, similarity, textprep
from gleaner.operators import fulltext, papers, records
from gleaner.sources import files, schemas

NOW = "2024-01-01T00:00:00Z"


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def found(spark, *texts):
    docs = spark.createDataFrame([(f"2301.0000{i}v1.md", t) for i, t in enumerate(texts)], "id string, content string")
    return sorted((r.doc_id, r.type, r.url) for r in fulltext.found(docs).collect())


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("see https://github.com/u/r.", [("github", "https://github.com/u/r")]),
        ("git-\nhub.com / user / repo", [("github", "https://github.com/user/repo")]),
        ("g i t h u b . c o m/a/b", [("github", "https://github.com/a/b")]),
        ("git­hub.com/a/b", [("github", "https://github.com/a/b")]),
        ("github.com/a/b/wiki github.com/a/b/issues/12 me.github.io/x github.com/a/b/blob/m/x.csv", []),
        ("https://github.com/a/b https://github.com/A/B/releases", [("github", "https://github.com/a/b")]),
        ("(www.gitlab.com/a/b.git),", [("gitlab", "https://gitlab.com/a/b")]),
        ("sourceforge.net/projects/x", []),
        ("github.com/a/b/wiki.", [("github", "https://github.com/a/b")]),
        ("github.com/a/...", [("github", None)]),
        ("GitHub.com/a/b", []),
        ("pypi.org/project/x/ npmjs.com/package/@s/p", [("npm", "https://npmjs.com/package/@s/p"), ("pypi", "https://pypi.org/project/x")]),
        ("", []),
        (None, []),
    ],
)
def test_fulltext_cases(spark, text, want):
    assert [x[1:] for x in found(spark, text)] == want


def test_same_link_in_two_documents_is_kept(spark):
    assert len(found(spark, "github.com/a/b", "github.com/a/b")) == 2


def test_every_document_stays(spark):
    docs = spark.createDataFrame([("a", "github.com/a/b"), ("b", "none"), (None, "github.com/c/d"), ("a", "x")], "id string, content string")
    assert sorted((str(r.id), len(r.urls)) for r in fulltext.with_urls(docs).collect()) == [("None", 0), ("a", 1), ("a", 1), ("b", 0)]


def test_enrichments_need_a_preprint_id(spark):
    docs = spark.createDataFrame([("2308.11197v1.md", "github.com/a/b"), ("invalid.md", "github.com/a/b"), (None, "github.com/a/b")], "id string, content string")
    rows = fulltext.enrichments(docs, NOW).collect()
    assert [(r.doi, r.enrichedValue.relatedIdentifier, r.enrichedValue.relationType, r.created) for r in rows] == [("10.48550/arxiv.2308.11197", "https://github.com/a/b", "References", NOW)]
    stats = {(r.metric, r.name): r.value for r in fulltext.stats(docs).collect()}
    assert stats == {("total_papers", ""): 3, ("papers_with_urls", ""): 1, ("total_urls", ""): 1, ("urls_by_type", "github"): 1}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("GITHUB.com/User/Repo.git &amp; more", ["https://github.com/User/Repo"]),
        ("githubXcom/a/b", ["https://github.com/a/b"]),
        ("github.com/actions/checkout", []),
        ("www.npmjs.com/package/@scope/a www.npmjs.com/package/@scope/b", ["https://www.npmjs.com/package/@scope/a"]),
        ("http://codeocean.com/capsule/12", ["https://codeocean.com/capsule/12"]),
        ("github.com/a/. github.com/a/..", []),
        ("pypi.org/project/one/ and PyPI.org/project/ONE", ["https://pypi.org/project/one"]),
    ],
)
def test_record_cases(spark, text, want):
    t = spark.createDataFrame([("r", 0, text)], "rec_id string, part long, text string")
    assert [r.url for r in records.extract(t).collect()] == want


def test_known_identifiers_are_skipped(spark):
    r = spark.createDataFrame([("10.1/a", "Abstract", "github.com/a/b github.com/c/d", "http://www.github.com/A/B/", "URL"), ("10.1/b", "Methods", "github.com/a/b", None, "URL"), ("10.1/c", "Other", "github.com/a/b", None, "URL")], "id string, k string, t string, i string, ik string")
    full = r.selectExpr("id", "named_struct('doi', cast(null as string), 'descriptions', array(named_struct('description', t, 'descriptionType', k)), 'relatedIdentifiers', array(named_struct('relatedIdentifier', i, 'relatedIdentifierType', ik))) AS attributes")
    assert sorted((x.doi, x.enrichedValue.relatedIdentifier) for x in records.enrichments(full, NOW).collect()) == [("10.1/a", "https://github.com/c/d"), ("10.1/c", "https://github.com/a/b")]


@pytest.mark.parametrize(("url", "key"), [("https://www.github.com/A/B/tree/x", "github.com/a/b"), ("sourceforge.net/projects/x/files", "sourceforge.net/projects/x"), ("https://www.npmjs.com/package/@s/p", "npmjs.com/package/@s"), ("https://x.org/y/", "x.org/y")])
def test_base_key(spark, url, key):
    assert one(spark, url, links.base_key) == key


@pytest.mark.parametrize(("raw", "a", "b"), [(" https://doi.org/10.1/X ", "10.1/x", " https://doi.org/10.1/x "), ("doi:10.1/X", "10.1/x", "doi:10.1/x"), ("http://dx.doi.org/10.1/X", "http://dx.doi.org/10.1/x", "10.1/x"), ("https://doi.org/doi:10.1/x", "10.1/x", "doi:10.1/x")])
def test_dois(spark, raw, a, b):
    assert one(spark, raw, identifiers.record_doi) == a
    assert one(spark, raw, identifiers.paper_doi) == b


@pytest.mark.parametrize(("raw", "want"), [("10.48550/arXiv.2308.11197", "2308.11197"), ("https://arxiv.org/abs/2308.11197v2", "2308.11197"), ("2308.11197v12", "2308.11197"), ("HEP-th/9901001", "hep-th/9901001")])
def test_arxiv_ids(spark, raw, want):
    assert one(spark, raw, identifiers.normalised_arxiv_id) == want


def test_arxiv_match(spark):
    rows = spark.createDataFrame([("2308.11197v1", "see 2308.11197", None), ("2308.11197", "no", "arXiv 2308.11197v3"), (None, "x", "x"), ("2308.11197", "", None)], "p string, r string, d string")
    got = [r.m for r in rows.select(identifiers.arxiv_match(F.col("p"), F.col("r"), F.col("d")).alias("m")).collect()]
    assert [(m.matched, m.location, m.skip_reason) for m in got] == [(True, "readme", None), (True, "description", None), (False, None, "no_paper_arxiv_id"), (False, None, "no_content")]


def test_name_similarity(spark):
    rows = spark.createDataFrame([("deep-parser", "Deep parser for the trees"), ("transformr", "transformer"), (None, "x"), ("x", None), ("the", "of")], "a string, b string")
    got = [r.m for r in rows.select(similarity.name_match(F.col("a"), F.col("b")).alias("m")).collect()]
    assert got[0].matched and got[0].containment == 1.0
    assert round(got[1].fuzzy, 4) == 0.9524
    assert [m.skip_reason for m in got[2:]] == ["no_repo_name", "no_paper_title", None]
    assert got[4].score == 0.0


def test_paper_projection_and_last_wins(spark, tmp_path):
    lines = [
        '{"id": "10.1/A", "attributes": {"titles": [{"title": "T1"}], "creators": [{"name": "Last, First, Jr", "nameType": "Personal"}, {"name": "Org", "nameType": "Organizational"}], "identifiers": [{"identifier": "2301.00001", "identifierType": "arXiv"}]}}',
        "not json",
        '{"id": "x", "attributes": {"doi": "10.1/a"}}',
    ]
    (tmp_path / "r.jsonl").write_text("\n".join(lines) + "\n\n")
    r = files.read_records(spark, str(tmp_path / "r.jsonl"))
    p = papers.papers(r).collect()
    assert [(x.doi, x.title, x.authors, x.arxiv_id) for x in p] == [("10.1/A", "T1", ["First, Jr Last"], "2301.00001"), ("10.1/a", None, [], None)]
    with pytest.raises(ValueError, match="datacite"):
        papers.papers(r, "other")
    numbered = papers.papers(r).withColumn("idx", F.monotonically_increasing_id())
    assert [(x.key, x.title) for x in papers.by_doi(numbered).collect()] == [("10.1/a", None)]


def test_jsonl_keeps_nulls_and_order(spark, tmp_path):
    docs = spark.createDataFrame([("2308.11197v1.md", "github.com/a/b github.com/c/d")], "id string, content string")
    files.write_jsonl(fulltext.enrichments(docs, NOW), str(tmp_path / "out"))
    back = files.with_order(spark, str(tmp_path / "out"), schemas.ENRICHMENT)
    assert '"originalValue":null' in spark.read.text(str(tmp_path / "out")).first().value
    assert [r.enrichedValue.relatedIdentifier for r in back.orderBy("idx").collect()] == ["https://github.com/a/b", "https://github.com/c/d"]
    assert files.default_output("a/x.jsonl.gz", "validate") == "a/x.jsonl_validated.jsonl"


def test_html_entities(spark):
    assert one(spark, "a &lt;b&gt; &eacute;", textprep.unescape_html) == "a <b> é"
    assert one(spark, None, textprep.unescape_html) is None


def test_common_subsequence_against_plain(spark):
    import random

    rng = random.Random(1)

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    pairs = [("".join(rng.choice("abcd ") for _ in range(rng.choice([0, 1, 5, 30, 59, 60, 61, 70]))), "".join(rng.choice("abcd ") for _ in range(rng.choice([0, 1, 7, 60, 61, 80])))) for _ in range(120)]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", similarity.lcs_length(F.col("a"), F.col("b")).alias("n"))
    assert all(r.n == plain(r.a, r.b) for r in df.collect())
