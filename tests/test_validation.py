"""Validation, promotion, healing, streaming and the command line."""

import json

import pytest

from gleaner import cli
from gleaner.operators import authors, promote, validate
from gleaner.plans.queries import same_name
from gleaner.sources import files
from gleaner.sources.probers import GraphqlProber, HttpProber, TableProber, graphql_query
from gleaner.streaming.extract import stream_enrichments


def test_check_asks_each_link_once_and_logs(spark, tmp_path):
    urls = spark.createDataFrame([("https://github.com/a/b",), ("https://pypi.org/project/x",), ("https://crates.io/crates/c",)], "url string")
    cache = spark.createDataFrame([("https://github.com/a/b", True, "m", None)], "url string, valid boolean, method string, error string")
    table = TableProber(spark.createDataFrame([("https://pypi.org/project/x", False, "t", "gone")], "url string, valid boolean, method string, error string"))
    got = validate.check(urls, cache, {"github": table, "pypi": table}, str(tmp_path / "log"), "2024-01-01T00:00:00Z")
    assert sorted((r.url, r.valid, r.error) for r in got.collect()) == [("https://github.com/a/b", True, None), ("https://pypi.org/project/x", False, "gone")]


def test_http_prober_maps_status(spark):
    urls = spark.createDataFrame([("https://pypi.org/project/x", "pypi"), ("https://zenodo.org/1", "zenodo"), ("https://npmjs.com/", "npm")], "url string, kind string")
    got = HttpProber(get=lambda kind, address: (200 if "pypi" in address else 410, None)).probe(urls).collect()
    assert sorted((r.url, r.valid, r.method, r.error) for r in got) == [("https://npmjs.com/", False, "api_check", "invalid_url"), ("https://pypi.org/project/x", True, "api_check", None), ("https://zenodo.org/1", False, "http_head", "gone")]


def test_graphql_batches(spark):
    repos = spark.createDataFrame([(f"u{i}", "o", f"r{i}") for i in range(3)], "url string, owner string, repo string")
    answer = json.dumps({"data": {"repo0": {"id": "x"}, "repo1": None}, "errors": [{"path": ["repo1"], "type": "NOT_FOUND"}]})
    got = GraphqlProber(lambda q: (200, {}, answer), batch=2, spacing=0.0).responses(repos)
    assert sorted((r.url, r.valid, r.error) for r in validate.existence(got).collect()) == [("u0", True, None), ("u1", False, "NOT_FOUND"), ("u2", True, None)]
    assert 'repo0: repository(owner: "o", name: "a\\"b") { id }' in graphql_query([("o", 'a"b')])


def _promotion(spark):
    records = spark.createDataFrame([(0, "10.1/a", "https://github.com/l/deep-parser", "References", True), (1, "10.1/A", "https://github.com/l/deep-parser", "References", True), (2, "10.1/b", "https://github.com/l/other", None, True), (3, "10.1/c", "https://gitlab.com/l/x", "References", True), (4, "10.1/zz", "https://github.com/l/deep-parser", "References", False)], "idx long, doi string, url string, relation string, is_valid boolean")
    papers = spark.createDataFrame([("10.1/a", "Deep parser", ["Ann Bee"], "2308.11197"), ("10.1/b", "Deep parser", ["Ann Bee"], "2308.11197")], "doi string, title string, authors array<string>, arxiv_id string")
    repos = spark.createDataFrame([("https://github.com/l/deep-parser", None, "arXiv 2308.11197", [], None), ("https://github.com/l/other", None, "2308.11197v2", [("x", "Ann Bee", None)], None)], "url string, description string, readme_content string, contributors array<struct<login:string,name:string,email:string>>, fetch_error string")
    return records, papers, repos


def test_per_pair_order_and_chunks(spark):
    args = _promotion(spark)
    got = {r.idx: r for r in promote.per_pair(*args, same_name).collect()}
    assert [(got[i].promoted, got[i].skip_reason) for i in range(5)] == [(True, None), (False, "url_already_promoted"), (True, None), (None, None), (False, "no_paper_record")]
    assert got[0].relation == "IsSupplementedBy" and got[2].signals == ["arxiv_id_in_readme", "author_match"]
    late = {r.idx: r.skip_reason for r in promote.per_pair(*args, same_name, chunk=2).collect()}
    assert late[4] == "url_already_promoted"


def test_per_url_first_record_decides(spark):
    got = {r.idx: r for r in promote.per_url(*_promotion(spark), same_name).collect()}
    assert [got[i].promoted for i in range(5)] == [True, True, True, None, True]
    assert got[4].relation == "isSupplementedBy" and got[3].relation == "References"


def test_author_skips(spark):
    items = spark.createDataFrame([("u", "d", [], ["A"]), ("v", "d", [("x", "A", None)], [])], "url string, doi string, contributors array<struct<login:string,name:string,email:string>>, authors array<string>")
    assert sorted((r.url, r.skip_reason) for r in authors.matches(items, same_name).collect()) == [("u", "no_contributors"), ("v", "no_authors")]
    assert {r.skip_reason for r in authors.matches(items, None).collect()} == {"no_model"}


def test_record_order_is_that_of_files_and_lines(spark, tmp_path):
    """Several files of unequal size, blank lines among them: dense numbers in file and line order."""
    want = []
    for name, n in (("a.json", 3), ("b.json", 1400), ("c.json", 50)):
        lines = [f'{{"url": "{name}-{i}"}}' for i in range(n)]
        want += [f"{name}-{i}" for i in range(n)]
        (tmp_path / name).write_text("\n\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = sorted((r.idx, r.url) for r in files.with_order(spark, str(tmp_path), "url string").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(enumerate(want))


def test_corrupt_log_lines_raise(spark, tmp_path):
    (tmp_path / "log").write_text('{"url": "a"}\n{"url": \n')
    assert files.with_order(spark, str(tmp_path / "log"), "url string").count() == 2
    with pytest.raises(Exception, match="not JSON"):
        files.with_order(spark, str(tmp_path / "log"), "url string", strict=True).collect()


def test_unknown_kinds_get_a_result(spark, tmp_path):
    urls = spark.createDataFrame([("https://crates.io/crates/x",), ("https://github.com/a/b",)], "url string")
    table = spark.createDataFrame([("https://github.com/a/b", True, "m", None)], "url string, valid boolean, method string, error string")
    got = validate.check(urls, table.limit(0), {"github": TableProber(table)}, str(tmp_path / "log"), "2024-01-01T00:00:00Z", unknown=True).collect()
    assert sorted((r.url, r.valid, r.method, r.error) for r in got) == [("https://crates.io/crates/x", False, "none", "no_validator"), ("https://github.com/a/b", True, "m", None)]


def test_stream(spark, tmp_path):
    spark.createDataFrame([("2308.11197v1.md", "github.com/a/b")], "id string, content string").write.parquet(str(tmp_path / "in"))
    q = stream_enrichments(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), "2024-01-01T00:00:00Z")
    q.awaitTermination(120)
    assert spark.read.text(str(tmp_path / "out")).count() == 1


def test_command_line(spark, tmp_path, capsys):
    spark.createDataFrame([("2308.11197v1.md", "github.com/l/deep-parser")], "relative_path string, content string").write.parquet(str(tmp_path / "in.parquet"))
    (tmp_path / "log").write_text('{"url": "https://github.com/l/deep-parser", "valid": true, "method": "m"}\n')
    (tmp_path / "rec").write_text('{"id": "10.48550/arxiv.2308.11197", "attributes": {"titles": [{"title": "Deep parser"}], "identifiers": [{"identifier": "2308.11197", "identifierType": "arXiv"}]}}\n')
    (tmp_path / "meta").write_text('{"url": "https://github.com/l/deep-parser", "readme_content": "arXiv 2308.11197", "contributors": []}\n')
    p = lambda x: str(tmp_path / x)
    assert cli.main(["extract", p("in.parquet"), "-o", p("e")]) == 0
    assert capsys.readouterr().out.splitlines() == ["total_papers 1", "papers_with_urls 1", "total_urls 1", "urls_by_type github 1"]
    assert cli.main(["validate", p("e"), "--results", p("log"), "-o", p("v")]) == 0
    assert cli.main(["promote", p("v"), "--records", p("rec"), "--metadata", p("meta"), "-o", p("p"), "--batch"]) == 0
    out = json.loads(spark.read.text(p("p")).first().value)
    assert out["enrichedValue"]["relationType"] == "IsSupplementedBy" and out["_promotion"]["signals"] == ["arxiv_id_in_readme", "name_similarity"]
    (tmp_path / "rec2").write_text("".join('{"id": "10.48550/arxiv.2308.11197", "attributes": {"titles": [{"title": "%s"}]}}\n' % t for t in ("Deep parser", "Other words")))
    (tmp_path / "w").write_text(spark.read.text(p("v")).first().value.replace("10.48550", "https://doi.org/10.48550") + "\n")
    assert cli.main(["promote", p("w"), "--records", p("rec2"), "--metadata", p("meta"), "-o", p("p2"), "--batch"]) == 0
    verdict = json.loads(spark.read.text(p("p2")).first().value)["_promotion"]
    assert verdict.get("skip_reason") is None and "name_similarity" not in verdict["signals"]  # DOIs with a prefix match, the last paper wins
    capsys.readouterr()
    assert cli.main(["heal-fulltext", p("in.parquet"), "-o", p("h")]) == 0
    assert capsys.readouterr().out.splitlines() == ["total 1", "healed 0", "warnings 1"]  # hardly any blanks
    spark.createDataFrame([("2308.11197v1.md", "github.com/\n\n\nl/one `" + "``"), ("2308.11198v1.md", "two\nlines of it."), ("x.md", "```")], "relative_path string, content string").write.parquet(p("bad.parquet"))
    assert cli.main(["extract", p("bad.parquet"), "--heal-markdown", "-o", p("eh")]) == 0
    told = dict(x.rsplit(" ", 1) for x in capsys.readouterr().out.splitlines())
    assert told["total_papers"] == "3" and told["healing_warnings"] == "2" and int(told["total_urls"]) == spark.read.text(p("eh")).count()


class Counted:
    """A scorer that keeps what it was shown."""

    def __init__(self):
        self.calls = []

    def __call__(self, texts):
        self.calls.append(list(texts))
        return ["match" if "yes" in t else "no" for t in texts], [0.5] * len(texts)


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_early_exit_scores_no_batch_after_the_first_match(chunk):
    """Items of 0 to 100 pairs, the match at any place, rows in frames of any size: the results of all pairs, and no batch of an
    item after the one with its match."""
    want, rows = {}, []
    for n, at in enumerate([0, 5, 31, 32, 33, 63, 64, 99, None, 12]):
        pairs = [("u", f"{n:02}", f"login{i}", f"author{i}", f"{n}:{i}:" + ("yes" if at is not None and i in (at, at + 3) else "")) for i in range(100)]
        rows += pairs
        if at is not None:
            want["u", f"{n:02}"] = (f"login{at}", f"author{at}")
    score = Counted()
    state, got = authors.EarlyExit(score, "match", 32, 8), []
    for i in range(0, len(rows), chunk):
        state.add(iter(rows[i : i + chunk]))
        got += list(state.hits(rows[min(i + chunk, len(rows)) - 1][:2]))
    got += list(state.hits(None))
    assert {g[:2]: g[2:4] for g in got} == want and len(got) == len(want)
    shown = [t for call in score.calls for t in call]
    assert len(shown) == len(set(shown)) and max(map(len, score.calls)) <= 256
    for n, at in enumerate([0, 5, 31, 32, 33, 63, 64, 99, None, 12]):
        last = max(int(t.split(":")[1]) for t in shown if t.startswith(f"{n}:"))
        assert last < (100 if at is None else min(100, (at // 32 + 1) * 32))
    if chunk == 1000:
        assert max(map(len, score.calls)) > 32  # several items in one call


def test_first_only_is_the_first_of_all(spark):
    people = [(f"p{i}", f"Name {i}", None) for i in range(20)]
    items = spark.createDataFrame([(f"u{n}", "d", people, [f"Other {i}" for i in range(n)] + [f"Name {n}", "Name 3"]) for n in range(12)], "url string, doi string, contributors array<struct<login:string,name:string,email:string>>, authors array<string>")
    key = lambda df: {r.url: [(m.contributor, m.author) for m in r.matches][:1] for r in df.collect()}
    assert key(authors.matches(items, same_name, first_only=True)) == key(authors.matches(items, same_name))


def test_long_strings_are_compared_by_blocks(spark):
    """Against a plain table, and 480 characters in milliseconds."""
    import random
    import time

    from pyspark.sql import functions as F

    from gleaner.functions.similarity import indel_ratio, lcs_length

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            prev, row = row, [0]
            for j, y in enumerate(b):
                row.append(prev[j] + 1 if x == y else max(prev[j + 1], row[j]))
        return row[-1]

    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdé f") for _ in range(n))
    sizes = [(61, 61), (60, 61), (119, 120), (120, 121), (121, 180), (181, 240), (300, 90), (480, 480)]
    pairs = [(word(a), word(b)) for a, b in sizes for _ in range(3)] + [("x" * 130, "x" * 125), ("ab" * 70, "ba" * 65)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", lcs_length(F.col("a"), F.col("b")).alias("n"), indel_ratio(F.col("a"), F.col("b")).alias("r")).collect():
        n = plain(r.a, r.b)
        assert r.n == n and abs(r.r - (1 - (len(r.a) + len(r.b) - 2 * n) / (len(r.a) + len(r.b)))) < 1e-12
    many = spark.createDataFrame([(word(480), word(480)) for _ in range(200)], "a string, b string").repartition(4).cache()
    many.count()
    began = time.time()
    many.select(F.sum(lcs_length(F.col("a"), F.col("b")))).collect()
    assert (time.time() - began) / 200 < 0.05  # 1.4 s a pair by the table


def test_figures_are_those_of_the_written_rows(spark):
    """Taken while writing; equal to the figures of a pass of their own."""
    from gleaner.operators import fulltext

    rows = [(f"2308.{i:05}v1.md" if i % 3 else f"note{i}", " ".join(["github.com/a/b", "pypi.org/project/x", "github.com/a/...", "gitlab.com/q/r"][: i % 5])) for i in range(200)]
    docs = spark.createDataFrame(rows, "id string, content string").repartition(5)
    out, figures = fulltext.observed(docs, "now")
    got = out.collect()
    assert sorted(map(str, got)) == sorted(map(str, fulltext.enrichments(docs, "now").collect()))
    assert sorted(figures()) == sorted((r.metric, r.name, r.value) for r in fulltext.stats(docs).collect())


def test_lines_that_no_doi_asks_for_are_not_parsed(spark, tmp_path):
    from gleaner.operators import papers

    lines = ['{"id": "10.1/A", "attributes": {"titles": [{"title": "t"}]}}', '{"id": "x", "attributes": {"doi": "10.1/b"}}', "{broken", "", '{"id": "10.1/c"}', '{"id": "10.1/a", "attributes": {"doi": null}}']
    (tmp_path / "r").write_text("\n".join(lines))
    dois = spark.createDataFrame([("10.1/A",), ("10.1/b",), (None,)], "doi string")
    got = papers.read_wanted(spark, str(tmp_path / "r"), dois)
    assert sorted((r.idx, r.id) for r in got.collect()) == [(0, "10.1/A"), (1, "x"), (4, "10.1/a")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("from_json") < plan.index("LeftSemi") or "from_json" in plan.split("LeftSemi")[0]


def test_texts_of_repositories_stay_below_the_joins(spark):
    """READMEs of up to a megabyte are searched once a repository and not carried to its links and papers."""
    for engine in (promote.per_pair, promote.per_url):
        plan = engine(*_promotion(spark), same_name)._jdf.queryExecution().optimizedPlan().toString()
        scans = [line for line in plan.splitlines() if "readme_content" in line]
        assert scans and all("Join" not in line for line in scans)
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        joins = [n for n, line in enumerate(plan.splitlines()) if "Join" in line]
        for n, line in enumerate(plan.splitlines()):
            if "readme_content" in line:  # no join stands below a node that still has the text
                below = [k for k in joins if k > n and all(depth(x) > depth(line) for x in plan.splitlines()[n + 1 : k + 1])]
                assert not below
