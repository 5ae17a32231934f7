"""Asking in lanes, the fetch loop, and the data source over a fake service."""

import json
import sys
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from gleaner.operators import fetch, validate
from gleaner.sources import lanes, repositories
from gleaner.sources.lanes import Later
from gleaner.sources.probers import GitProber, GraphqlProber, HttpProber, graphql_query

cloudpickle.register_pickle_by_value(sys.modules[__name__])
HIT = '{"data": {"repo0": {"id": "x"}}}'


def links(spark, names):
    return spark.createDataFrame([(n,) for n in names], "url string")


def test_lanes_bound_calls_over_all_tasks(spark, tmp_path):
    """Intervals of all calls, from all tasks: no more at a time than lanes, and than a host's lanes."""
    (tmp_path / "calls").mkdir()
    folder = str(tmp_path / "calls")

    def get(kind, address):
        began = time.time()
        time.sleep(0.02)
        with open(f"{folder}/{time.time_ns()}-{threading.get_ident()}", "w") as f:
            f.write(json.dumps([address.split("/")[2], began, time.time()]))
        return 200, None

    names = [f"https://zenodo.org/record/{i}" for i in range(80)] + [f"https://figshare.com/{i}" for i in range(60)] + [f"https://h{i}.codeocean.com/x" for i in range(60)]
    kind = F.regexp_extract("url", r"(zenodo|figshare|codeocean)\.", 1)
    got = HttpProber(get=get, lanes=6, per_host=3).probe(links(spark, names).withColumn("kind", kind).repartition(4)).collect()
    assert len(got) == 200 and all(r.valid for r in got)
    calls = [json.loads(f.read_text()) for f in (tmp_path / "calls").iterdir()]
    assert len(calls) == 200

    def most(own):
        edges = sorted([(b, 1) for _, b, _ in own] + [(e, -1) for _, _, e in own])
        open_now = peak = 0
        for _, d in edges:
            open_now += d
            peak = max(peak, open_now)
        return peak

    assert 3 < most(calls) <= 6  # several at a time, but never more than lanes
    assert max(most([c for c in calls if c[0] == h]) for h in {c[0] for c in calls}) <= 3


def test_a_host_has_its_lanes_only(spark):
    urls = links(spark, [f"https://pypi.org/project/p{i}" for i in range(3000)])
    got = lanes.dealt(urls.withColumn("address", F.col("url")), HttpProber())
    assert got.select("lane").distinct().count() == 20
    with pytest.raises(ValueError, match="a host has"):
        lanes.dealt(urls, HttpProber(lanes=5, per_host=6))


def test_in_turn_requeues_and_waits():
    now, slept, tries = [100.0], [], Counter()

    def sleep(s):
        slept.append(s)
        now[0] += s

    def attempt(item):
        tries[item] += 1
        if item == "limited" and tries[item] <= 5:
            return Later(now[0] + 60, free=True)
        if item == "weak" and tries[item] < 3:
            return Later(now[0] + 2 ** (tries[item] - 1))
        return Later(now[0] + 1, "http_500") if item == "broken" else item.upper()

    got = list(lanes.in_turn(["weak", "limited", "fine", "broken"], attempt, 3, clock=lambda: now[0], sleep=sleep))
    assert [g[0] for g in got] == ["fine", "broken", "weak", "limited"]
    assert got[1][1].error == "http_500" and tries == {"weak": 3, "limited": 6, "fine": 1, "broken": 3}
    assert now[0] == 400.0  # five times a minute: the limit's end is waited for, and costs no try
    gaps = list(lanes.in_turn(list("abc"), lambda x: x, 1, spacing=3.0, clock=lambda: now[0], sleep=sleep))
    assert len(gaps) == 3 and now[0] == 406.0


def test_a_limit_with_a_reset_time_costs_no_try():
    until = time.time() + 0.3
    said = iter([(403, {"X-RateLimit-Remaining": "0", "X-RateLimit-Reset": str(until)}, "")] * 3 + [(200, {}, HIT)])
    asked = []

    def post(query):
        asked.append(query)
        return next(said)

    p = GraphqlProber(post, tries=1, spacing=0.0)
    ((_, got),) = list(lanes.in_turn([[{"url": "u", "owner": "o", "repo": "r"}]], p.attempt, p.tries))
    assert got == [{"urls": ["u"], "response": HIT}] and time.time() >= until and len(asked) == 4
    assert p.failed([{"url": "u"}], "x") == [{"urls": ["u"], "response": None}]
    with pytest.raises(ValueError, match="not accepted"):
        GraphqlProber(lambda q: (401, {}, "")).attempt([{"url": "u", "owner": "o", "repo": "r"}])


def test_http_retries_then_gives_up(monkeypatch):
    monkeypatch.setattr(lanes.time, "sleep", lambda s: None)
    said = []

    def get(kind, address):
        said.append(address)
        return (503, None) if "bad" in address else (None, "timeout") if len(said) < 2 else (200, None)

    p, now = HttpProber(get=get), [0.0]
    rows = [[{"url": u, "kind": "zenodo", "address": u}] for u in ("slow", "bad")]
    out = [r for _, g in lanes.in_turn(rows, p.attempt, 3, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s)) for r in (p.failed([{"url": "bad", "kind": "zenodo"}], g.error) if isinstance(g, Later) else g)]
    assert out == [{"url": "slow", "valid": True, "method": "http_head", "error": None}, {"url": "bad", "valid": False, "method": "http_head", "error": "http_503"}]
    assert said.count("bad") == 3 and said.count("slow") == 2 and not p.used


def test_names_are_escaped():
    assert 'repository(owner: "o", name: "a\\\\")' in graphql_query([("o", "a\\")])


@pytest.mark.parametrize(("code", "said", "error"), [(0, "", None), (2, "", "not_found"), (128, "Repository NOT found", "not_found"), (128, "fatal: Authentication failed", "auth_required"), (128, "odd", "error"), (128, None, "error")])
def test_git_agrees_with_its_columns(spark, code, said, error):
    """The prober and the Column of the same rule say the same."""
    from gleaner.sources.probers import git_result

    (got,) = GitProber(run=lambda args, t: (code, said)).attempt([{"url": "u"}])
    assert (got["valid"], got["error"]) == (error is None, error)
    valid, column = git_result(F.lit(code), F.lit(said).cast("string"))
    assert tuple(spark.range(1).select(valid, column).first()) == (error is None, error)


@pytest.mark.parametrize("kind", ["zenodo", "pypi"])
def test_http_agrees_with_its_columns(spark, kind):
    from gleaner.sources.probers import http_result

    for status in (200, 301, 404, 410, 500):
        p = HttpProber(get=lambda k, a: (status, None), tries=1)  # noqa: B023
        got = p.attempt([{"url": "u", "kind": kind, "address": "a"}])
        (r,) = p.failed([{"url": "u", "kind": kind}], got.error) if isinstance(got, Later) else got
        valid, error = http_result(F.lit(status), F.lit(kind == "zenodo"))
        assert (r["valid"], r["error"]) == tuple(spark.range(1).select(valid, error).first())


# --- the fetch loop ---


class Counting(HttpProber):
    """Writes down every call; dies at the given one."""

    def __init__(self, folder, dies_at=None):
        super().__init__(lanes=4, per_host=4, tries=1)
        self.folder, self.dies_at = str(folder), dies_at

    def attempt(self, rows):
        import os

        url = rows[0]["url"]
        with open(f"{self.folder}/{time.time_ns()}-{threading.get_ident()}", "w") as f:
            f.write(url)
        if self.dies_at and len(os.listdir(self.folder)) >= self.dies_at:
            raise RuntimeError("killed")
        return [{"url": url, "valid": not url.endswith("3"), "method": "m", "error": "not_found" if url.endswith("3") else None}]


def told(folder):
    return Counter(f.read_text() for f in folder.iterdir())


def test_a_killed_run_resumes_and_asks_no_link_twice(spark, tmp_path):
    calls, log = tmp_path / "calls", f"file://{tmp_path}/log"
    calls.mkdir()
    names = [f"https://zenodo.org/{i}" for i in range(60)]
    urls = links(spark, [*names, names[0], "", None]).withColumn("kind", F.lit("zenodo"))
    with pytest.raises(Exception, match="killed"):
        fetch.fetched(urls, log, Counting(calls, dies_at=25))
    before = told(calls)
    assert len(fetch.runs(log)[1]) == 1 and fetch.answers(spark, log, HttpProber.schema).count() == 0
    got = fetch.fetched(urls, log, Counting(calls))
    assert {r.url: r.valid for r in got.collect()} == {u: not u.endswith("3") for u in names} and got.count() == 60
    after = told(calls)
    assert set(after) == set(names) and sum(before.values()) >= 25
    # Four lanes: what was open in each of them when the run died, and no more, is asked again.
    assert sum(after.values()) <= 60 + 8 and max(after.values()) == 2
    more = fetch.fetched(links(spark, [names[5], "https://zenodo.org/new"]).withColumn("kind", F.lit("zenodo")), log, Counting(calls))
    assert told(calls) - after == Counter({"https://zenodo.org/new": 1}) and more.count() == 61
    assert fetch.runs(log)[1] == [] or all(not fetch._ended(log, "answers", r) for r in fetch.runs(log)[1])


def test_a_run_killed_between_answers_asks_each_link_once(spark, tmp_path):
    """Lanes that ended are in the journal: after a kill between two calls, nothing is asked twice."""
    calls, log = tmp_path / "calls", f"file://{tmp_path}/log"
    calls.mkdir()
    p = Counting(calls)
    urls = links(spark, [f"https://zenodo.org/{i}" for i in range(20)]).withColumn("kind", F.lit("zenodo"))
    plan = p.plan(urls)
    plan.write.parquet(f"{log}/plans/r")
    lanes.asked(spark.read.parquet(f"{log}/plans/r").where("lane % 2 = 0"), p, f"{log}/journals/r").collect()  # the driver dies here: no answers
    some = told(calls)
    assert 0 < len(some) < 20
    assert fetch.fetched(urls, log, p).count() == 20
    assert set(told(calls).values()) == {1} and len(told(calls)) == 20


def test_check_uses_the_loop(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    urls = links(spark, ["https://zenodo.org/1", "https://zenodo.org/3", "https://crates.io/crates/x"])
    cache = spark.createDataFrame([("https://zenodo.org/1", True, "old", None)], "url string, valid boolean, method string, error string")
    for _ in range(2):
        got = validate.check(urls, cache, {"zenodo": Counting(calls)}, f"file://{tmp_path}/log", "2024-01-01T00:00:00Z", unknown=True)
        assert sorted((r.url, r.valid, r.method) for r in got.collect()) == [("https://crates.io/crates/x", False, "none"), ("https://zenodo.org/1", True, "old"), ("https://zenodo.org/3", False, "m")]
    assert told(calls) == Counter({"https://zenodo.org/3": 1})


# --- the data source ---


@pytest.fixture
def service():
    """A fake service: owners `gone` have no repository; the token `weak` lacks scopes, `wrong` is refused."""
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            query = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["query"]
            token = self.headers["Authorization"].removeprefix("Bearer ")
            seen.append((token, query))
            import re

            repos = re.findall(r'(repo\d+): repository\(owner: "([^"]*)", name: "([^"]*)"\)', query)
            status, body = 200, {"data": {k: None if o == "gone" else {"id": n, "description": f"{o}/{n}", "readme_rst": {"text": "read me"}, "mentionableUsers": {"nodes": [{"login": o, "name": None, "email": ""}]}} for k, o, n in repos}}
            if token == "wrong":
                status, body = 401, {"message": "Bad credentials"}
            elif token == "weak" and "viewer" in query:
                body = {"errors": [{"type": "INSUFFICIENT_SCOPES", "message": "This requires one of the following scopes: ['read:user'], but your token has only been granted the: ['repo', 'gist'] scopes."}]}
            self.send_response(status)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def log_message(self, *a):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", seen
    server.shutdown()


NAMES = ["https://github.com/a/one", "https://github.com/a/two.git", "https://github.com/gone/x", "https://github.com/only-owner", "https://github.com/b/three"]


def test_source_gives_existence_and_metadata(spark, service, tmp_path):
    endpoint, seen = service
    got = repositories.responses(spark, links(spark, NAMES), f"file://{tmp_path}/a", endpoint, "good", lanes=2, batch=2, spacing=0.0)
    assert {r.url: (r.valid, r.error) for r in validate.existence(got).collect()} == {NAMES[0]: (True, None), NAMES[1]: (True, None), NAMES[2]: (False, "not_found"), NAMES[3]: (False, "invalid_url"), NAMES[4]: (True, None)}
    assert any("viewer" in q for _, q in seen) and max(q.count("repository(") for _, q in seen) <= 2
    meta = repositories.responses(spark, links(spark, NAMES), f"file://{tmp_path}/b", endpoint, "good", lanes=2, spacing=0.0, metadata=True)
    rows = {r.url: r for r in validate.metadata(meta).collect()}
    assert rows[NAMES[4]].description == "b/three" and rows[NAMES[4]].readme_content == "read me" and rows[NAMES[4]].contributors[0].login == "b"
    assert (rows[NAMES[2]].fetch_error, rows[NAMES[3]].fetch_error) == ("not_found", "invalid_url")


def test_scopes_are_asked_for_before_any_task(spark, service, tmp_path):
    endpoint, seen = service
    for token, message in (("weak", "one of read:user is needed, it has repo, gist"), ("wrong", "not accepted")):
        with pytest.raises(Exception, match=message):
            repositories.responses(spark, links(spark, NAMES), f"file://{tmp_path}/{token}", endpoint, token, spacing=0.0).collect()
    assert seen and all("viewer" in q for _, q in seen)  # nothing but the preflight was sent


def test_missing_metadata_is_fetched_once(spark, service, tmp_path):
    endpoint, seen = service
    schema = "url string, description string, readme_content string, contributors array<struct<login:string,name:string,email:string>>, fetch_error string"
    known = spark.createDataFrame([(NAMES[0], "known", None, [], None)], schema)
    p = GraphqlProber(repositories.Post(endpoint, "good"), metadata=True, spacing=0.0)
    for _ in range(2):
        got = {r.url: r for r in fetch.missing_metadata(links(spark, NAMES), known, f"file://{tmp_path}/log", p).collect()}
        assert got[NAMES[0]].description == "known" and got[NAMES[4]].description == "b/three" and len(got) == 5
    asked = "".join(q for _, q in seen)
    assert asked.count('name: "three"') == 1 and 'name: "one"' not in asked
    valid = fetch.as_validation(fetch.missing_metadata(links(spark, NAMES), known, f"file://{tmp_path}/log", p))
    assert {(r.valid, r.error) for r in valid.collect()} == {(True, None), (False, "not_found"), (False, "invalid_url")} and {r.method for r in valid.collect()} == {"graphql_promotion"}


# --- the command ---


def lines(path):
    return [json.loads(x) for f in sorted(path.glob("part-*")) for x in f.read_text().splitlines()]


def test_validate_and_promote_from_the_command_line(spark, service, tmp_path, monkeypatch):
    """Metadata is fetched once, taken as validation, and promotes; a second call asks nothing; a weak token ends it."""
    from gleaner import cli

    endpoint, seen = service
    monkeypatch.setenv("CODE_TOKEN", "good")
    real = cli.probers
    table = spark.createDataFrame([("https://pypi.org/project/x", True, "t", None)], "url string, valid boolean, method string, error string")
    monkeypatch.setattr(cli, "probers", lambda a: {k: v for k, v in real(a).items() if k == "github"})
    record = lambda url, doi: json.dumps({"doi": doi, "enrichedValue": {"relatedIdentifier": url, "relationType": "References"}}) + "\n"
    (tmp_path / "in").write_text("".join(record(u, f"10.1/{i}") for i, u in enumerate([NAMES[0], NAMES[2], "https://github.com/b/deep-parser", "https://pypi.org/project/x", "https://crates.io/crates/c"])))
    table.write.json(str(tmp_path / "known"))
    (tmp_path / "rec").write_text(json.dumps({"id": "10.1/2", "attributes": {"titles": [{"title": "deep parser"}], "creators": [{"nameType": "Personal", "name": "b", "givenName": "b", "familyName": "b"}]}}) + "\n")
    args = ["validate", str(tmp_path / "in"), "--results", str(tmp_path / "known"), "--log", str(tmp_path / "log"), "--endpoint", endpoint, "--token-variable", "CODE_TOKEN", "--spacing", "0"]
    more = ["--promote", "--records", str(tmp_path / "rec"), "--threshold", "1", "--keep-invalid"]
    assert cli.main([*args, *more, "-o", str(tmp_path / "a")]) == 0
    got = {x["enrichedValue"]["relatedIdentifier"]: x for x in lines(tmp_path / "a")}
    assert len(got) == 4 and got[NAMES[0]]["_validation"]["method"] == "graphql_promotion" and got["https://pypi.org/project/x"]["_validation"]["method"] == "t"
    assert got[NAMES[2]]["_validation"] == {"is_valid": False, "method": "graphql_promotion", "error": "not_found"}
    assert got["https://github.com/b/deep-parser"]["enrichedValue"]["relationType"] == "IsSupplementedBy"
    assert got[NAMES[0]]["_promotion"]["skip_reason"] == "no_paper_record" and "https://crates.io/crates/c" not in got
    before = [q for _, q in seen if "viewer" not in q]
    assert cli.main([*args, *more, "-o", str(tmp_path / "b")]) == 0
    assert [q for _, q in seen if "viewer" not in q] == before and lines(tmp_path / "b") == lines(tmp_path / "a")
    assert cli.main([*args, "--no-validator", "--keep-invalid", "-o", str(tmp_path / "c")]) == 0
    other = {x["enrichedValue"]["relatedIdentifier"]: x["_validation"] for x in lines(tmp_path / "c")}
    assert other["https://crates.io/crates/c"]["error"] == "no_validator" and other[NAMES[0]]["method"] == "graphql"
    monkeypatch.setenv("CODE_TOKEN", "weak")
    assert cli.main([*args, "-o", str(tmp_path / "d")]) == 1
    with pytest.raises(SystemExit):
        cli.main(["validate", str(tmp_path / "in"), "--log", "x", "--promote"])


def test_a_scorer_is_named(spark):
    from gleaner import cli

    assert cli.scorer("gleaner.plans.queries:same_name") is __import__("gleaner.plans.queries", fromlist=["x"]).same_name and cli.scorer(None) is None
