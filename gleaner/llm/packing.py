"""Packing by optimal length buckets.

The histogram of lengths over all documents goes to the driver, one row a distinct length: no more rows than the longest
text has tokens. Dynamic programming over it (lines kept as a lower envelope: linear in the histogram for each bucket)
chooses the bucket boundaries with the least padding. Inside each bucket, documents are put in the order of a hash and cut
into batches that hold the token budget when padded. `token_batches` forms them: ids, padded to the bucket's end, and the
lengths, which are the mask.

Tokens are what stands between white space, counted once and written down. Nulls and empty texts have 0 tokens and go to
the first bucket. A document over the budget is a batch by itself. Repeated rows are each packed. Every row gets a place;
columns other than doc_id and text are not read, so that none can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, numbered

#: White space besides the blank.
SPACES = "\t\n\x0b\f\r"
PAD = 0


def words(text: str = "text") -> Column:
    """What stands between white space. All in one pass: a long run of white space costs no more than other text."""
    t = F.translate(F.coalesce(F.col(text), F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(t, " "), "")


def n_tokens(text: str = "text") -> Column:
    return F.size(words(text)).cast("long")


def token_ids(text: str = "text") -> Column:
    """An id of 1 to 2**31 - 1 for each word, from its hash."""
    return F.transform(words(text), lambda w: (F.pmod(F.xxhash64(w), F.lit((1 << 31) - 1)) + 1).cast("int"))


def boundaries(histogram: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """The upper ends, at most `buckets`, that minimise padding. histogram: (upper end, rows, sum of lengths)."""
    h = sorted(histogram)
    if not h:
        return []
    b, c, s = [x[0] for x in h], [0], [0]
    for _, rows, total in h:
        c.append(c[-1] + rows)
        s.append(s[-1] + total)
    m = len(h)
    best, back = [b[j - 1] * c[j] - s[j] if j else 0 for j in range(m + 1)], []
    for _ in range(min(buckets, m) - 1):
        # new[j] = b_j c_j - s_j + min over i < j of (best_i + s_i) - b_j c_i: lines of falling slope, asked at rising b_j
        lines, at, new, via = [], 0, [0], [0]
        for j in range(1, m + 1):
            k, d, x = -c[j - 1], best[j - 1] + s[j - 1], b[j - 1]
            while len(lines) - at >= 2 and (d - lines[-2][1]) * (lines[-2][0] - lines[-1][0]) <= (lines[-1][1] - lines[-2][1]) * (lines[-2][0] - k):
                lines.pop()
            lines.append((k, d, j - 1))
            while at + 1 < len(lines) and lines[at + 1][0] * x + lines[at + 1][1] <= lines[at][0] * x + lines[at][1]:
                at += 1
            new.append(lines[at][0] * x + lines[at][1] + x * c[j] - s[j])
            via.append(lines[at][2])
        best = new
        back.append(via)
    ends, j = [b[m - 1]], m
    while back and (j := back.pop()[j]):
        ends.append(b[j - 1])
    return sorted(ends)


def _planned(sized: DataFrame, buckets: int, budget: int) -> DataFrame:
    """sized (doc_id, n_tokens, and more narrow columns) with bucket, pad_to, batch and place."""
    c = F.col
    sized = materialise(sized, "sizes")
    hist = sized.groupBy(c("n_tokens").alias("end")).agg(F.count("*").alias("rows"), F.sum("n_tokens").alias("total")).collect()  # one row a distinct length
    ends = boundaries([tuple(x) for x in hist], buckets)
    if not ends:
        return sized.select("*", *[F.lit(0).cast("long").alias(x) for x in ("bucket", "pad_to", "batch", "place")])
    rows = [sum(n for e, n, _ in hist if lo < e <= hi) for lo, hi in zip([-1, *ends], ends, strict=False)]
    starts = [sum(rows[:i]) for i in range(len(rows))]
    pick = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values]), c("bucket").cast("int") + 1).cast("long")
    bucket = sum((F.when(c("n_tokens") > e, 1).otherwise(0) for e in ends), F.lit(0)).cast("long")
    order = F.md5(F.coalesce(c("doc_id").cast("string"), F.lit("null")))
    placed, _ = numbered(sized.withColumn("bucket", bucket).withColumn("h", order), [c("bucket"), c("h"), c("n_tokens")], "lengths")
    at = c("idx") - pick(starts)
    each = pick([max(1, budget // max(1, e)) for e in ends])
    return placed.select(*sized.columns, "bucket", pick(ends).alias("pad_to"), F.floor(at / each).cast("long").alias("batch"), F.pmod(at, each).alias("place"))


def length_buckets(docs: DataFrame, buckets: int = 16, budget: int = 65536) -> DataFrame:
    """doc_id, n_tokens, bucket, pad_to, batch (numbered in its bucket), place (in its batch)."""
    return _planned(docs.select("doc_id", n_tokens().alias("n_tokens")), buckets, budget)


def token_batches(docs: DataFrame, buckets: int = 16, budget: int = 65536) -> DataFrame:
    """bucket, batch, pad_to, doc_ids, lengths, ids: one row a batch. ids holds the rows of the batch one after another, each
    padded with `PAD` to pad_to; lengths are the tokens before the padding. A batch holds the budget at most, or one
    document."""
    key = F.md5(F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))).alias("key")
    plan = _planned(docs.select("doc_id", n_tokens().alias("n_tokens"), key), buckets, budget)
    # Rows that repeat in full have one text for all their places.
    texts = docs.select(key, token_ids().alias("ids")).dropDuplicates(["key"])
    row = F.struct("place", "doc_id", "n_tokens", F.concat("ids", F.array_repeat(F.lit(PAD), (F.col("pad_to") - F.col("n_tokens")).cast("int"))).alias("ids"))
    one = plan.join(texts, "key").groupBy("bucket", "batch", "pad_to").agg(F.array_sort(F.collect_list(row)).alias("r"))  # a batch, so the budget at most
    part = lambda k: F.transform("r", lambda x: x[k])
    return one.select("bucket", "batch", "pad_to", part("doc_id").alias("doc_ids"), part("n_tokens").alias("lengths"), F.flatten(part("ids")).alias("ids"))
