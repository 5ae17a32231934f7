"""Probers: what asks the outside whether a link exists.

`HttpProber`, `GitProber` and `GraphqlProber` go out from executors, in lanes (`sources.lanes`): their bounds hold over the whole
job. `TableProber` answers from a table. A probe has side effects, so results are logged before they are joined
(`operators.fetch`)."""

from __future__ import annotations

import json
import subprocess
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.links import check_url, repo_parts
from . import lanes
from .lanes import Later
from .schemas import PROBE


def http_result(status: Column, generic: Column) -> tuple[Column, Column]:
    """valid, error for an HTTP status; 410 is `gone` for generic pages."""
    valid = status == 200
    error = F.when(valid, F.lit(None)).when(status == 404, "not_found").when(generic & (status == 410), "gone").otherwise(F.concat(F.lit("http_"), status.cast("string")))
    return valid, error


def git_result(code: Column, stderr: Column) -> tuple[Column, Column]:
    """valid, error for the exit of a listing of a remote repository."""
    low = F.lower(F.coalesce(stderr, F.lit("")))
    error = (
        F.when(code == 0, F.lit(None)).when(code == 2, "not_found").when(F.contains(low, F.lit("not found")) | F.contains(low, F.lit("does not exist")), "not_found")
        .when(F.contains(low, F.lit("permission denied")) | F.contains(low, F.lit("authentication")), "auth_required").otherwise("error")
    )
    return code == 0, error


class TableProber:
    """Answers from a table url, valid, method, error; links that it lacks are not found."""

    def __init__(self, table: DataFrame):
        self.table = table

    def probe(self, urls: DataFrame) -> DataFrame:
        known = self.table.select("url", "valid", "method", "error")
        return urls.join(known, "url", "left").select("url", F.coalesce("valid", F.lit(False)).alias("valid"), F.coalesce("method", F.lit("table")).alias("method"), F.when(F.col("valid").isNull(), "not_found").otherwise(F.col("error")).alias("error"))


# Kinds that a registry's API answers for, and kinds whose pages can be gone.
API_KINDS, GENERIC_KINDS = ("pypi", "npm"), ("zenodo", "figshare", "codeocean", "software_heritage")
FINAL = (None, "not_found", "gone", "invalid_url")


def _result(url: str, error: str | None, method: str) -> dict:
    return {"url": url, "valid": error is None, "method": method, "error": error}


class _Lanes:
    """Asks in lanes; `wanted` adds what an attempt needs to know of a link."""

    schema, batch, spacing = PROBE, 1, 0.0

    def wanted(self, urls: DataFrame) -> DataFrame:
        return urls

    def plan(self, urls: DataFrame) -> DataFrame:
        return lanes.dealt(self.wanted(urls), self)

    def probe(self, urls: DataFrame) -> DataFrame:
        return lanes.asked(self.plan(urls), self)


class HttpProber(_Lanes):
    """HEAD or GET on the registry's address. 100 calls at a time, 20 to a host; three tries, 1 and 2 s apart at least.
    A limit with the time of its end (429, or 403 with nothing left) is waited for. get: (kind, address) to (status, error)
    or (status, error, headers)."""

    def __init__(self, timeout: float = 10.0, lanes: int = 100, per_host: int = 20, tries: int = 3, get=None):
        self.timeout, self.lanes, self.per_host, self.tries, self.get = timeout, lanes, per_host, tries, get
        self.used: dict[str, int] = {}

    def __getstate__(self):
        return self.__dict__ | {"used": {}}

    def wanted(self, urls: DataFrame) -> DataFrame:
        return urls.select("url", "kind", check_url(F.col("url"), F.col("kind")).alias("address"))

    def _get(self, kind: str, address: str) -> tuple:
        if self.get is not None:
            return self.get(kind, address)
        import requests

        try:
            r = (requests.get if kind in API_KINDS else requests.head)(address, timeout=self.timeout, allow_redirects=True)
            return r.status_code, None, r.headers
        except requests.Timeout:
            return None, "timeout"
        except requests.RequestException:
            return None, "request_error"

    def _method(self, kind: str) -> str:
        return "api_check" if kind in API_KINDS else "http_head"

    def attempt(self, rows: list[dict]) -> list[dict] | Later:
        (row,) = rows
        url, kind, address = row["url"], row["kind"], row["address"]
        if not address:
            return [_result(url, "invalid_url", self._method(kind))]
        code, error, *more = self._get(kind, address)
        if until := limited(code, more[0] if more else {}):
            return Later(until, f"http_{code}", free=True)
        if error is None:
            error = None if code == 200 else "not_found" if code == 404 else "gone" if kind in GENERIC_KINDS and code == 410 else f"http_{code}"
        if error in FINAL:
            self.used.pop(url, None)
            return [_result(url, error, self._method(kind))]
        k = self.used[url] = self.used.get(url, 0) + 1
        return Later(time.time() + 2 ** (k - 1), error)

    def failed(self, rows: list[dict], error: str) -> list[dict]:
        self.used.pop(rows[0]["url"], None)
        return [_result(rows[0]["url"], error, self._method(rows[0]["kind"]))]


def limited(code: int | None, headers) -> float | None:
    """When a limit ends, if an answer names one: seconds since the epoch."""
    low = {str(k).lower(): v for k, v in dict(headers).items()}
    if code in (403, 429) and low.get("x-ratelimit-remaining") == "0" and low.get("x-ratelimit-reset"):
        return float(low["x-ratelimit-reset"])
    if code == 429 and str(low.get("retry-after", "")).isdigit():
        return time.time() + float(low["retry-after"])
    return None


class GitProber(_Lanes):
    """Lists the remote repository; run: (arguments, timeout) to (code, errors), for tests."""

    tries = 1

    def __init__(self, timeout: float = 10.0, lanes: int = 50, per_host: int = 50, run=None):
        self.timeout, self.lanes, self.per_host, self.run = timeout, lanes, per_host, run

    def wanted(self, urls: DataFrame) -> DataFrame:
        return urls.select("url")

    def attempt(self, rows: list[dict]) -> list[dict]:
        url, method = rows[0]["url"], "git_ls_remote"
        args = ["git", "ls-remote", "--exit-code", "-h", url]
        try:
            if self.run is not None:
                code, said = self.run(args, self.timeout)
            else:
                r = subprocess.run(args, capture_output=True, text=True, timeout=self.timeout)
                code, said = r.returncode, r.stderr
        except subprocess.TimeoutExpired:
            return [_result(url, "timeout", method)]
        except FileNotFoundError:
            return [_result(url, "git_not_installed", method)]
        low = (said or "").lower()
        if code == 0:
            return [_result(url, None, method)]
        if code == 2 or "not found" in low or "does not exist" in low:
            return [_result(url, "not_found", method)]
        return [_result(url, "auth_required" if "permission denied" in low or "authentication" in low else "error", method)]

    def failed(self, rows: list[dict], error: str) -> list[dict]:
        return [_result(rows[0]["url"], error, "git_ls_remote")]


def graphql_query(repos: list[tuple[str, str]], metadata: bool = False) -> str:
    """One query for many repositories, alias repo0, repo1 and so on."""
    variants = {"readme_md": "README.md", "readme_rst": "README.rst", "readme_txt": "README.txt", "readme_plain": "README"}
    fields = "id"
    if metadata:
        fields = "description " + " ".join(f'{k}: object(expression: "HEAD:{v}") {{ ... on Blob {{ text }} }}' for k, v in variants.items()) + " mentionableUsers(first: 100) { nodes { login name email } }"
    quoted = [[json.dumps(x, ensure_ascii=False) for x in r] for r in repos]  # a name's quotes and backslashes stay in it
    return "query { " + " ".join(f"repo{i}: repository(owner: {o}, name: {n}) {{ {fields} }}" for i, (o, n) in enumerate(quoted)) + " }"


class GraphqlProber(_Lanes):
    """Asks the host's GraphQL service in batches. Its limit is global, so that a lane's calls are `spacing` times the lanes
    apart: together they keep to one call in `spacing` seconds. `post` takes the query and returns (status, headers, text);
    responses come back as rows for `operators.validate` to decode. An end of the limit that the service names is waited
    for and costs no try."""

    schema, tries = "urls array<string>, response string", 3

    def __init__(self, post, batch: int | None = None, spacing: float = 3.0, tries: int = 3, metadata: bool = False, lanes: int = 4):
        self.post, self.batch, self.tries, self.metadata = post, batch or (50 if metadata else 100), tries, metadata
        self.lanes = self.per_host = lanes
        self.spacing = spacing * lanes
        self.used: dict[str, int] = {}

    def __getstate__(self):
        return self.__dict__ | {"used": {}}

    def wanted(self, urls: DataFrame) -> DataFrame:
        owner, repo = repo_parts(F.col("url"))
        known = [F.col(k) if k in urls.columns else v for k, v in (("owner", owner), ("repo", repo))]
        return urls.select("url", known[0].alias("owner"), known[1].alias("repo"))

    def attempt(self, rows: list[dict]) -> list[dict] | Later:
        fine = [r for r in rows if r["owner"] and r["repo"]]
        bad = [{"urls": [r["url"]], "response": json.dumps({"data": None, "message": "invalid_url"})} for r in rows if not (r["owner"] and r["repo"])]
        if not fine:
            return bad
        status, headers, text = self.post(graphql_query([(r["owner"], r["repo"]) for r in fine], self.metadata))
        if status == 200:
            self.used.pop(fine[0]["url"], None)
            return [*bad, {"urls": [r["url"] for r in fine], "response": text}]
        if status == 401:
            raise ValueError("the token is not accepted")
        if until := limited(status, headers):
            return Later(until, "rate_limit", free=True)
        k = self.used[fine[0]["url"]] = self.used.get(fine[0]["url"], 0) + 1
        return Later(time.time() + 2 ** (k - 1), "request_failed")

    def failed(self, rows: list[dict], error: str) -> list[dict]:
        return [{"urls": [r["url"] for r in rows], "response": None}]

    def responses(self, repos: DataFrame) -> DataFrame:
        """repos: url, owner, repo. Returns urls (in alias order) and response (null if no try got an answer)."""
        return self.probe(repos)
