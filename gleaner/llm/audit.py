"""Filter interaction audit by Walsh-Hadamard sums.

A document that fails some of the `FILTERS` has a mask of five bits. For each part and label, one aggregate takes 32 signed
sums over the documents: the sum for w counts a document as -1 if its mask and w have an odd number of bits in common, else
as 1. The transform is its own inverse up to a factor of 32, so these sums give back exactly how many documents have which
mask. From those 32 cells everything else follows without another look at documents: what each filter removes at each step
of all 120 orders, and its Shapley value, in closed form: a document that fails k filters is removed by each of them in
120/k orders.

Filter E needs the least doc_id of each text, found by the text's SHA-256 (copies are combined before the shuffle).

Nulls: a null text is empty; a null lang is the part of the empty string; a null doc_id is neither smaller nor larger than
another, so that such a row never fails E and fails no other. Rows that repeat a doc_id are documents of their own; none of
those with a text's least id fails E. A document is good, or toxic, if any of its labels says so. Without documents there are
no parts and no rows. Further columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, materialise

#: The filters' names, in the order of their bits.
FILTERS = "ABCDE"
CELLS = 1 << len(FILTERS)
LEAST_WORDS, SHARE_DISTINCT, SHARE_CAPITALS = 200, 50, 3
ORDERS = ["".join(p) for p in permutations(FILTERS)]
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_mask(text: Column) -> Column:
    """Bits of A to D."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    counts = let(words, lambda w: F.struct(F.size(w).alias("all"), F.size(F.array_distinct(w)).alias("own")))
    chars = F.char_length(text)
    capitals = chars - F.char_length(F.translate(text, _CAPITALS, ""))
    few = let(counts, lambda n: F.when(n["all"] < LEAST_WORDS, 1).otherwise(0) + F.when(100 * n["own"] < SHARE_DISTINCT * n["all"], 2).otherwise(0))
    return few + F.when(100 * capitals > SHARE_CAPITALS * chars, 4).otherwise(0) + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, good, toxic, mask: one row a document."""
    c = F.col
    text = F.coalesce("text", F.lit(""))
    own = docs.select(c("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text_mask(text).alias("mask"))
    each = materialise(own, "masks")  # narrow: texts are read once
    ends = each.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    first = materialise(ends.select("digest", "first"), "copies")  # written, so that the join can split a text with many copies
    said = labels.groupBy(c("doc_id").cast("long").alias("doc_id")).agg(*[F.max(F.coalesce(c(k) == 1, F.lit(False))).alias(to) for k, to in (("quality", "good"), ("toxic", "toxic"))])
    known = each.join(first, "digest", "left").join(said, "doc_id", "left")
    copy = F.when(c("first") < c("doc_id"), 16).otherwise(0)
    return known.select("part", *[F.coalesce(k, F.lit(False)).alias(k) for k in ("good", "toxic")], (c("mask") + copy).alias("mask"))


def _sign(a: Column, b: Column | int) -> Column:
    """-1 if a and b have an odd number of bits in common, else 1."""
    return 1 - 2 * F.bit_count(a.bitwiseAND(b if isinstance(b, Column) else F.lit(b))).bitwiseAND(F.lit(1))


def parity_sums(masked: DataFrame) -> DataFrame:
    """part, good, toxic, sums (array of 32)."""
    sums = [F.sum(_sign(F.col("mask"), w)).alias(f"w{w}") for w in range(CELLS)]
    found = masked.groupBy("part", "good", "toxic").agg(*sums)
    return found.select("part", "good", "toxic", F.array(*[f"w{w}" for w in range(CELLS)]).alias("sums"))


def cells(sums: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents with that mask, all of them, the good ones and the toxic ones."""
    each = sums.select("part", "good", "toxic", "sums", F.explode(F.sequence(F.lit(0), F.lit(CELLS - 1))).alias("mask"))
    signed = F.aggregate(F.transform("sums", lambda s, w: s * _sign(F.col("mask"), w)), F.lit(0).cast("long"), lambda a, x: a + x)
    counted = each.withColumn("n", F.shiftright(signed, len(FILTERS)))  # divides exactly
    of = lambda k: F.sum(F.when(F.col(k), F.col("n")).otherwise(0)).alias(k)
    return counted.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good"), of("toxic"))


def evaluated(found: DataFrame) -> DataFrame:
    """One row a part, order and step."""
    c = F.col
    parts = found.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("mask", "n", "good", "toxic"))).alias("m"))  # 32 cells
    steps = [(o, k + 1, 1 << FILTERS.index(f), sum(1 << FILTERS.index(x) for x in o[:k])) for o in ORDERS for k, f in enumerate(o)]
    orders = F.transform(F.split(F.lit(",".join(f"{o}:{k}:{bit}:{before}" for o, k, bit, before in steps)), ","), lambda x: F.split(x, ":"))
    each = parts.select("part", "m", F.explode(orders).alias("o")).select("part", "m", c("o")[0].alias("filter_order"), *[c("o")[i].cast("int").alias(k) for i, k in ((1, "step"), (2, "bit"), (3, "before"))])

    def total(value, test) -> Column:
        zero = F.lit(0).cast("long")
        return F.aggregate(F.transform("m", lambda x, i: F.when(test(i), value(x, i)).otherwise(zero)), zero, lambda a, x: a + x)

    has = lambda i, bits: i.bitwiseAND(bits) != 0
    n, bit, before = lambda x, i: x["n"], c("bit"), c("before")
    gone = lambda i: has(i, bit) & ~has(i, before)
    won = lambda x, i: x["n"] * (F.lit(len(ORDERS)) / F.bit_count(i)).cast("long")
    return each.select(
        "part", "filter_order", "step",
        total(n, lambda i: ~has(i, bit.bitwiseOR(before))).alias("kept"),
        total(n, gone).alias("removed"),
        total(n, lambda i: has(i, bit) & has(i, before)).alias("redundant"),
        total(n, lambda i: i == bit).alias("unique_fails"),
        total(lambda x, i: x["good"], gone).alias("good_lost"),
        total(lambda x, i: x["toxic"], gone).alias("toxic_lost"),
        total(won, lambda i: has(i, bit)).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step (int), and long counts of documents: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley."""
    return evaluated(cells(parity_sums(masks(docs, labels))))


ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t),
          regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS fails
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
o AS (
  SELECT a || b || c || d || e AS filter_order
  FROM (SELECT unnest(['A','B','C','D','E']) AS a), (SELECT unnest(['A','B','C','D','E']) AS b), (SELECT unnest(['A','B','C','D','E']) AS c),
       (SELECT unnest(['A','B','C','D','E']) AS d), (SELECT unnest(['A','B','C','D','E']) AS e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5),
s AS (
  SELECT filter_order, step::INTEGER AS step, ascii(substr(filter_order, step, 1)) - 64 AS me,
         list_transform(range(1, step), lambda k: ascii(substr(filter_order, k::INTEGER, 1)) - 64) AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
x AS (
  SELECT part, filter_order, step, n, good, toxic, me, fails[me] AS fail, len(list_filter(before, lambda k: fails[k])) > 0 AS earlier,
         len(list_filter(fails, lambda b: b)) AS failed
  FROM g, s),
r AS (
  SELECT part, filter_order, step, me,
         sum(CASE WHEN NOT fail AND NOT earlier THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN fail AND NOT earlier THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN fail AND earlier THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN fail AND failed = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN fail AND NOT earlier THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN fail AND NOT earlier THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM x GROUP BY part, filter_order, step, me)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, me))::BIGINT AS shapley
FROM r
"""
