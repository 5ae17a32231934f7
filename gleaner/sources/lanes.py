"""Asking the outside within bounds that hold over the whole job, whatever Spark runs at a time.

Links are dealt to lanes. A lane asks one link (or one batch) after another, all lanes together are `lanes` in number, and a
host's links go to `per_host` of them at most: so no more calls than these are open in all and to a host, with any number of
tasks on any number of executors. A task works through its lanes in threads. An attempt that should be repeated goes back
into its lane's queue with the time from which it may be asked; the lane goes on with other links until then. Waiting for a
limit to be lifted costs no try.

A prober has `lanes`, `per_host`, `batch` (links a call), `tries`, `spacing` (seconds from a lane's call to its next), `schema` (of a
result), `attempt(rows)`, which returns results or a `Later`, and `failed(rows, error)`, the results when no try is left.

With a journal (a folder that all executors reach), results are written as they come, each part complete once it has its
name. A task that runs again, or a job that is started again over the same plan, takes them from there and asks for the
rest only; what is asked twice at most is what was open when the task ended.
"""

from __future__ import annotations

import heapq
import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Later:
    """Ask again at this time (seconds since the epoch); free: the attempt costs no try."""

    at: float
    error: str = "request_error"
    free: bool = False


def number(text: Column) -> Column:
    """A number from 0 to 2**32 - 1 that depends on the text only."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def lane(url: Column, address: Column, lanes: int, per_host: int) -> Column:
    """A host's links are in per_host neighbouring lanes, from one that its name chooses."""
    host = F.regexp_extract(F.coalesce(address, url), r"^(?:https?://)?([^/]+)", 1)
    return F.pmod(number(host) + F.pmod(number(url), F.lit(per_host)), F.lit(lanes)).cast("int")


def dealt(urls: DataFrame, prober) -> DataFrame:
    """urls (url, and what the prober needs) with their lane."""
    if not 0 < prober.per_host <= prober.lanes:
        raise ValueError("a host has one lane at least, and no more than there are")
    address = F.col("address") if "address" in urls.columns else F.col("url")
    return urls.withColumn("lane", lane(F.col("url"), address, prober.lanes, prober.per_host))


def in_turn(items: list, attempt: Callable, tries: int, spacing: float = 0.0, clock: Callable = time.time, sleep: Callable = time.sleep, last: float = 0.0) -> Iterator[tuple]:
    """One lane: item and outcome (a result, or the last Later when no try is left) of each item, in the order in which
    they end."""
    queue = [(0.0, n, 0, item) for n, item in enumerate(items)]
    while queue:
        at, n, used, item = heapq.heappop(queue)
        wait = max(at, last + spacing if last else 0.0) - clock()
        if wait > 0:
            sleep(wait)
        last = clock()
        out = attempt(item)
        if isinstance(out, Later) and used + (not out.free) < tries:
            heapq.heappush(queue, (out.at, n, used + (not out.free), item))
        else:
            yield item, out


class Journal:
    """What a lane has been told so far. Used by one thread at a time."""

    def __init__(self, folder: str, of: int):
        from pyarrow import fs

        self.fs, path = fs.FileSystem.from_uri(folder)
        self.path = f"{path}/lane-{of}"
        self.fs.create_dir(self.path)
        self.done, self.rows = set(), []
        for f in self.fs.get_file_info(fs.FileSelector(self.path)):
            if f.path.endswith(".jsonl"):
                with self.fs.open_input_stream(f.path) as stream:
                    for line in stream.read().decode().splitlines():
                        entry = json.loads(line)
                        self.done.update(entry["urls"])
                        self.rows += entry["rows"]

    def add(self, urls: list[str], rows: list[dict]) -> None:
        name = f"{self.path}/{uuid.uuid4().hex}"
        with self.fs.open_output_stream(name + ".part") as stream:
            stream.write((json.dumps({"urls": urls, "rows": rows}) + "\n").encode())
        self.fs.move(name + ".part", name + ".jsonl")


def asked(plan: DataFrame, prober, journal: str | None = None) -> DataFrame:
    """The prober's results for a plan (urls with their lane). A lane's rows are one task's, so that it is one queue."""
    spark = plan.sparkSession
    if spark.conf.get("spark.speculation", "false") == "true":
        raise ValueError("with spark.speculation, two tasks would ask for the same links")
    tasks = max(1, min(prober.lanes, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    names = [c for c in plan.columns if c != "lane"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        journals: dict[int, Journal] = {}
        last: dict[int, float] = {}
        lock = threading.Lock()

        def work(of: int, rows: list[dict]) -> list[dict]:
            out, kept = [], None
            if journal is not None:
                with lock:
                    kept = journals.get(of)
                if kept is None:
                    kept = Journal(journal, of)
                    out += kept.rows
                    with lock:
                        journals[of] = kept
                rows = [r for r in rows if r["url"] not in kept.done]
            groups = [rows[i : i + prober.batch] for i in range(0, len(rows), prober.batch)]
            for group, got in in_turn(groups, prober.attempt, prober.tries, prober.spacing, last=last.get(of, 0.0)):
                results = prober.failed(group, got.error) if isinstance(got, Later) else got
                if kept is not None:
                    kept.add([r["url"] for r in group], results)
                out += results
            last[of] = time.time() if groups else last.get(of, 0.0)
            return out

        columns = [c.split()[0] for c in prober.schema.replace("array<string>", "a").split(", ")]
        with ThreadPoolExecutor(prober.lanes) as pool:
            for frame in frames:
                own: dict[int, list[dict]] = {}
                for of, *values in frame[["lane", *names]].itertuples(index=False, name=None):
                    own.setdefault(of, []).append(dict(zip(names, values, strict=True)))
                for results in pool.map(lambda x: work(*x), own.items()):
                    yield pd.DataFrame(results, columns=columns)

    return plan.repartition(tasks, "lane").mapInPandas(run, prober.schema)
