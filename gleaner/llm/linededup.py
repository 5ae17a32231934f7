"""Line deduplication by content-defined chunks, in DataFrame functions only.

A text is its lines. A chunk starts at every line and ends with the first line at which it counts, and another ends at
every line and starts with the last line at which it counts: content alone decides where both are, so that they move
with the content and not with its place. A chunk counts from two lines with `multi` words, or as a single line with
`single` words (passages often come as one paragraph line); both are parameters, `MULTI` and `SINGLE` unless given. Any run of lines that counts is covered by the chunks within
it: by the one from each line or, near its end, by the one that ends with its last line. No edge is needed, and no passage is missed.

Chunks are counted over the whole corpus by hash. Each occurrence but the first (by doc_id, then text, then
place) is removed once its bytes equal those of the first.

Some copy of every line stays: the first one in that order could only be removed for a still earlier one.

Nulls: a null text stays null; null ids come first. Rows repeated in full are treated alike. Further columns are kept,
but for earlier n_lines and n_removed.
Every row is returned, a text that repeats throughout becomes empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, row_key

MULTI, SINGLE = 10, 20
CHUNK = "array<struct<start:int,end:int,hash:bigint>>"


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def _least(w: Column, i: Column, way: int, multi: int, single: int) -> Column:
    """How many lines from line i on, or back, count as a chunk; null if all do not. A line has one word at least, so `multi` lines do."""
    total = F.get(w, i)
    n = F.when(total >= single, 1)
    for more in range(1, multi):
        total = total + F.get(w, i + way * more)
        n = n.when(total >= multi, more + 1)
    return n


def _spans(w: Column, multi: int, single: int) -> Column:
    at = F.sequence(F.lit(0), F.size(w) - 1)
    span = lambda start, end: F.struct(start.alias("start"), end.alias("end"))
    on = F.transform(at, lambda i: span(i, i + _least(w, i, 1, multi, single)))
    back = F.transform(at, lambda i: span(i + 1 - _least(w, i, -1, multi, single), i + 1))
    return F.array_distinct(F.filter(F.concat(on, back), lambda c: c["start"].isNotNull() & c["end"].isNotNull()))


def chunks(text: Column, multi: int = MULTI, single: int = SINGLE) -> Column:
    """array of start, end (lines, end excluded) and hash."""
    def of(ls):
        hashes = F.transform(ls, lambda x: F.xxhash64(x))
        words = F.transform(ls, lambda x: F.char_length(x) - F.char_length(F.replace(x, F.lit(" "))) + 1)
        hashed = lambda h: F.transform(let(words, lambda w: _spans(w, multi, single)), lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), F.xxhash64(F.slice(h, c["start"] + 1, c["end"] - c["start"])).alias("hash")))
        return let(hashes, hashed)

    return let(lines(text), of)


def _key() -> Column:
    """16 bytes, never null: a join on it needs no filter, and so both joins of the texts find the same exchange."""
    return F.coalesce(F.unhex(row_key()), F.lit(b"")).alias("key")


def repeated_spans(base: DataFrame, multi: int = MULTI, single: int = SINGLE) -> DataFrame:
    """key, spans (start, end) of what repeats an earlier chunk. base: key, doc_id, text, all of them used, so that the
    exchange of texts by key serves the caller's join as well."""
    place = lambda: F.struct(F.col("doc_id"), F.col("key"), F.col("c.start"))
    each = base.select("key", "doc_id", F.explode(chunks(F.col("text"), multi, single)).alias("c")).select("key", "doc_id", "c.*", place().alias("place"))
    often = each.groupBy("hash").agg(F.count("*").alias("n"), F.min("place").alias("first")).where("n > 1").drop("n")
    found = each.select("key", "start", "end", "hash").join(often, "hash")
    spans = found.groupBy("key").agg(F.collect_set(F.struct("start", "end", "hash", "first")).alias("spans"))
    cut = F.array_join(F.slice(lines(F.col("text")), F.col("s.start") + 1, F.col("s.end") - F.col("s.start")), "\n")
    mine = base.join(spans, "key").select("key", "doc_id", "text", F.explode("spans").alias("s"))
    is_first = F.struct(F.col("doc_id"), F.col("key"), F.col("s.start")) == F.col("s.first")
    texts = mine.select("key", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.hash").alias("hash"), cut.alias("bytes"), F.coalesce(is_first, F.lit(False)).alias("is_first"))
    one = texts.where("is_first").groupBy("hash").agg(F.first("bytes").alias("model"))
    again = texts.where("not is_first").join(one, "hash").where(F.col("bytes") == F.col("model"))
    return again.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def without_repeats(docs: DataFrame, multi: int = MULTI, single: int = SINGLE) -> DataFrame:
    """The rows of docs with cleaned text, and n_lines, n_removed (0 for null texts)."""
    docs = docs.drop("n_lines", "n_removed")
    base = docs.select(_key(), "doc_id", "text")
    spans = repeated_spans(base, multi, single)
    more = [c for c in docs.columns if c not in ("doc_id", "text")]
    whole = docs.select(_key(), "doc_id", "text", F.struct(*more).alias("rest")) if more else base
    c = F.col
    gone = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["end"] - 1)))
    mine = whole.join(spans, "key", "left").withColumn("l", F.coalesce(lines(c("text")), F.array()))
    out = mine.withColumn("kept", F.when(c("spans").isNotNull(), F.array_except(F.sequence(F.lit(0), F.size("l") - 1), gone)))
    text = F.when(c("kept").isNull(), c("text")).otherwise(F.array_join(F.transform("kept", lambda i: F.get("l", i)), "\n"))
    n = F.size("l").cast("long")
    named = {"doc_id": c("doc_id"), "text": text} | {k: c("rest")[k] for k in more}
    return out.select(*[named[k].alias(k) for k in docs.columns], n.alias("n_lines"), F.coalesce(n - F.size("kept"), F.lit(0)).cast("long").alias("n_removed"))
