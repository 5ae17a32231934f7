"""Contributors matched with authors by a pair classifier.

A scorer is a function from a batch of inputs (pandas Series of texts) to (labels, confidences); it is made once a worker by
a factory. The classifier itself is not part of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The input that the classifier was trained on.
TEMPLATE = """<developer-details>
    <username>%s</username>
    <name>%s</name>
    <email>%s</email>
</developer-details>

---

<author-details>
    <name>%s</name>
</author-details>"""
MAX_CONTRIBUTORS = 20


def classifier_input(login: Column, name: Column, email: Column, author: Column) -> Column:
    none = lambda c: F.coalesce(c, F.lit("None"))
    return F.format_string(TEMPLATE, none(login), none(name), none(email), none(author))


def pairs(items: DataFrame, most: int = MAX_CONTRIBUTORS) -> DataFrame:
    """items: url, doi, contributors, authors. One row a contributor (with a login; the first `most`) and author."""
    people = F.slice(F.filter("contributors", lambda c: F.coalesce(c["login"], F.lit("")) != ""), 1, most)
    one = items.select("url", "doi", "authors", F.posexplode(people).alias("ci", "c"))
    return one.select("url", "doi", "ci", F.col("c.login").alias("login"), F.col("c.name").alias("name"), F.col("c.email").alias("email"), F.posexplode("authors").alias("ai", "author"))


def scored(found: DataFrame, factory: Callable[[], Callable], yes: str = "match") -> DataFrame:
    """The pairs that match, with confidence."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = factory()
        for texts in batches:
            labels, confidence = score(texts)
            yield pd.DataFrame({"label": labels, "confidence": confidence})

    udf = F.pandas_udf(run, "label string, confidence double")
    return found.withColumn("s", udf(classifier_input(F.col("login"), F.col("name"), F.col("email"), F.col("author")))).where(F.col("s.label") == yes).withColumn("confidence", F.col("s.confidence")).drop("s")


class EarlyExit:
    """Scores the pairs of each item in their order, `batch` at a time, and stops at the item's first match. A call of the model
    takes the next batches of several items together, so that early ends leave no call half empty. Rows come sorted by item."""

    def __init__(self, score: Callable, yes: str, batch: int, items: int):
        self.score, self.yes, self.batch, self.items = score, yes, batch, items
        self.waiting: dict[tuple, list[tuple]] = {}  # pairs not scored yet, by item
        self.done: tuple | None = None  # an item that has matched, while its rows still come

    def add(self, rows: Iterator[tuple]) -> None:
        for url, doi, *pair in rows:
            if (url, doi) != self.done:
                self.waiting.setdefault((url, doi), []).append(tuple(pair))

    def hits(self, last: tuple | None) -> Iterator[tuple]:
        """First matches. The item `last` may go on: of it, whole batches only are scored, and it can be told to stop."""
        while True:
            ready = [k for k, pairs in self.waiting.items() if k != last or len(pairs) >= self.batch][: self.items]
            if not ready:
                return
            now = [(k, p) for k in ready for p in self.waiting[k][: self.batch]]
            labels, confidence = self.score(pd.Series([p[-1] for _, p in now]))
            found = set()
            for (k, p), label, sure in zip(now, labels, confidence, strict=True):
                if label == self.yes and k not in found:
                    found.add(k)
                    yield (*k, p[0], p[1], float(sure))
            for k in ready:
                self.waiting[k] = self.waiting[k][self.batch :]
                if k in found:
                    self.done = k if k == last else self.done
                    del self.waiting[k]
                elif not self.waiting[k] and k != last:
                    del self.waiting[k]


def first_matches(found: DataFrame, factory: Callable[[], Callable], yes: str = "match", batch: int = 32, items: int = 8) -> DataFrame:
    """url, doi, login, author, confidence: each item's first pair that matches, in the order of contributors and authors."""
    columns = ["url", "doi", "login", "author", "text"]
    text = classifier_input(F.col("login"), F.col("name"), F.col("email"), F.col("author")).alias("text")
    rows = found.repartition("url", "doi").sortWithinPartitions("url", "doi", "ci", "ai").select("url", "doi", "login", "author", text)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, last = EarlyExit(factory(), yes, batch, items), None
        made = ["url", "doi", "login", "author", "confidence"]
        for frame in frames:
            if len(frame):
                state.add(frame[columns].itertuples(index=False, name=None))
                last = (frame["url"].iloc[-1], frame["doi"].iloc[-1])
                yield pd.DataFrame(list(state.hits(last)), columns=made)
        yield pd.DataFrame(list(state.hits(None)), columns=made)

    return rows.mapInPandas(run, "url string, doi string, login string, author string, confidence double")


def matches(items: DataFrame, factory: Callable[[], Callable] | None, first_only: bool = False) -> DataFrame:
    """url, doi, matched, matches, skip_reason: one row an item; (url, doi) is unique in items."""
    base = items.select("url", "doi", "contributors", "authors")
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    skip = F.when(F.lit(factory is None), "no_model").when(size("contributors") <= 0, "no_contributors").when(size("authors") <= 0, "no_authors")
    if factory is None:
        return base.select("url", "doi", F.lit(False).alias("matched"), F.array().cast("array<struct<contributor:string,author:string,confidence:double>>").alias("matches"), skip.alias("skip_reason"))
    match = F.struct(F.col("login").alias("contributor"), "author", "confidence")
    if first_only:
        hits = first_matches(pairs(base), factory).select("url", "doi", F.array(match).alias("matches"))
    else:
        one = F.array_sort(F.collect_list(F.struct("ci", "ai", match.alias("m"))))
        hits = scored(pairs(base), factory).groupBy("url", "doi").agg(F.transform(one, lambda x: x["m"]).alias("matches"))
    return base.select("url", "doi", skip.alias("skip_reason")).join(hits, ["url", "doi"], "left").select("url", "doi", F.col("matches").isNotNull().alias("matched"), F.coalesce("matches", F.array().cast("array<struct<contributor:string,author:string,confidence:double>>")).alias("matches"), "skip_reason")
