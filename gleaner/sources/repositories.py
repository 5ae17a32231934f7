"""A code host's GraphQL service as a data source: `spark.read.format("repositories")`.

Options: `links` (a folder of parquet with url, lane, as `lanes.dealt` makes it, partitioned by lane), `endpoint`, `token`,
`metadata` (true: description, README and contributors, else existence), `batch`, `lanes`, `spacing`, `tries`, `preflight`.

Rows are responses: urls (in alias order) and response, which `operators.validate` decodes. A partition is a lane; its
calls are `spacing` times the lanes apart, so that all lanes together keep to the service's rate. Before any task starts,
the driver asks once whether the token may see what the queries name; if not, reading fails with `ScopeError`.
"""

from __future__ import annotations

import json
import re
import urllib.error
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .lanes import Later, in_turn
from .probers import GraphqlProber

FORMAT = "repositories"
#: Any public repository will do.
PREFLIGHT = 'query { viewer { login } repository(owner: "octocat", name: "Hello-World") { description readme_md: object(expression: "HEAD:README.md") { ... on Blob { text } } mentionableUsers(first: 1) { nodes { login name email } } } }'
NEEDED = ["read:user", "user:email"]


class ScopeError(ValueError):
    """The token lacks scopes."""

    def __init__(self, required: list[str], current: list[str]):
        self.required, self.current = required, current
        super().__init__(f"the token lacks scopes: one of {', '.join(required)} is needed, it has {', '.join(current) or 'none that is known'}")


class Post:
    """Sends a query; (status, headers, text). Trouble on the way is status 0."""

    def __init__(self, endpoint: str, token: str, timeout: float = 30.0):
        self.endpoint, self.token, self.timeout = endpoint, token, timeout

    def __call__(self, query: str) -> tuple[int, dict, str]:
        headers = {"Authorization": f"Bearer {self.token}", "Content-Type": "application/json"}
        asked = urllib.request.Request(self.endpoint, json.dumps({"query": query}).encode(), headers)
        try:
            with urllib.request.urlopen(asked, timeout=self.timeout) as r:
                return r.status, dict(r.headers), r.read().decode()
        except urllib.error.HTTPError as e:
            return e.code, dict(e.headers), e.read().decode(errors="replace")
        except (urllib.error.URLError, TimeoutError, OSError) as e:
            return 0, {}, str(e)


def preflight(post) -> None:
    """Raises ScopeError, or ValueError for a token that is not accepted and for other refusals."""
    status, _, text = post(PREFLIGHT)
    if status == 401:
        raise ValueError("the token is not accepted")
    try:
        data = json.loads(text)
    except ValueError:
        raise ValueError(f"no answer from the service: status {status}") from None
    for error in data.get("errors") or []:
        if error.get("type") == "INSUFFICIENT_SCOPES":
            named = [re.search(p, error.get("message") or "") for p in (r"one of the following scopes: \[([^\]]+)\]", r"been granted the: \[([^\]]+)\]")]
            required, current = ([s.strip(" '") for s in m[1].split(",")] if m else [] for m in named)
            raise ScopeError(required or NEEDED, current)
    if "data" not in data:
        raise ValueError(f"the service refuses: {data.get('message', status)}")


class _Reader(DataSourceReader):
    def __init__(self, options):
        get = {k.lower(): v for k, v in options.items()}
        self.links, self.check = get["links"], get.get("preflight", "true") == "true"
        metadata = get.get("metadata", "false") == "true"
        post = Post(get["endpoint"], get.get("token", ""))
        self.prober = GraphqlProber(post, int(get["batch"]) if "batch" in get else None, float(get.get("spacing", 3.0)), int(get.get("tries", 3)), metadata, int(get.get("lanes", 4)))

    def partitions(self) -> list[InputPartition]:
        if self.check:
            preflight(self.prober.post)
        return [InputPartition(k) for k in range(self.prober.lanes)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import pyarrow.dataset as ds
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.links)
        own = f"{path}/lane={partition.value}"
        if system.get_file_info(own).type != fs.FileType.Directory:
            return
        p, last = self.prober, 0.0
        for part in ds.dataset(own, filesystem=system, format="parquet").to_batches(columns=["url", "owner", "repo"], batch_size=64 * p.batch):
            rows = part.to_pylist()
            groups = [rows[i : i + p.batch] for i in range(0, len(rows), p.batch)]
            import time

            for group, got in in_turn(groups, p.attempt, p.tries, p.spacing, last=last):
                last = time.time()
                for r in p.failed(group, got.error) if isinstance(got, Later) else got:
                    yield r["urls"], r["response"]


class RepositorySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return GraphqlProber.schema

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def responses(spark: SparkSession, urls: DataFrame, folder: str, endpoint: str, token: str, **options) -> DataFrame:
    """Responses for urls (url), which are dealt to lanes and written to the folder first."""
    spark.dataSource.register(RepositorySource)
    lanes = int(options.get("lanes", 4))
    GraphqlProber(None, lanes=lanes).plan(urls.select("url")).repartition(lanes, "lane").write.partitionBy("lane").parquet(folder)
    told = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}
    return spark.read.format(FORMAT).options(links=folder, endpoint=endpoint, token=token, **told).load()
