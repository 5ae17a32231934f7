"""Spelling variants by symmetric deletes.

Every word emits itself and its distinct single deletions, as 64-bit hashes; an equi-join on these keys gives candidates,
which are words at distance two at most; those at a distance of exactly one insertion, deletion or replacement are near. A
word's form is its near word with the most occurrences, if it has `ratio` times the word's own; roots are found by joining
forms to their own forms, twice as far each time.

A key's words differ in one code point at most from what the key stands for, so that a group of them is bounded by
alphabet and length, whatever the corpus: no group grows with the input. Words travel as numbers, and a word of any length
costs as many keys as it has code points.

Words are maximal runs of `LETTERS`, of which A to Z alone are lower-cased. With `noise`, a word whose hash (CRC-32 of
`<doc_id>:<word>`) that number divides loses the code point at hash modulo length, as a typist would lose it.

Nulls: a null text has no words; a null doc_id is written as the empty string. Rows repeated in full count as often as they
come. Ties go to the word that is smallest in code-point order. No words, no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .words import _powers, mix

#: What a word is made of.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_CHARS, LEAST_TIMES, RATIO, NOISE = 6, 5, 5, 199


def occurrences(docs: DataFrame, least_chars: int, noise: int | None) -> DataFrame:
    """word: one row an occurrence."""
    c = F.col
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lower, f"[^{LETTERS}]+"), lambda w: F.char_length(w) >= least_chars)
    each = docs.select(F.coalesce(c("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(words).alias("w"))
    if noise is None:
        return each.select(c("w").alias("word"))
    h = F.crc32(F.concat("id", F.lit(":"), "w"))
    # Substrings are only cut where the hash says so.
    at = (h % F.char_length("w")).cast("int")
    cut = F.concat(F.substring(c("w"), F.lit(1), at), F.substring(c("w"), at + 2, F.char_length("w")))
    return each.select(F.when(h % noise == 0, cut).otherwise(c("w")).alias("word")).where(F.char_length("word") >= least_chars)


def vocabulary(docs: DataFrame, least_chars: int = LEAST_CHARS, least_times: int = LEAST_TIMES, noise: int | None = NOISE) -> DataFrame:
    """id, word, n: written once."""
    counted = occurrences(docs, least_chars, noise).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_times)
    return materialise(counted.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")


def delete_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Which word, and key: each word's own and those of its distinct single deletions. A run of one code point gives one
    deletion. Hashes are sums over places, so that those of all deletions come from two running sums."""
    sizes = np.array([len(w) for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    begin = np.cumsum(sizes) - sizes
    place = np.arange(len(codes)) - begin[owner]
    up, down = _powers(int(sizes.max(initial=0)) + 1)
    terms = mix(codes + np.uint64(1)) * up[place]
    total = np.concatenate([[np.uint64(0)], np.cumsum(terms)])
    end = begin + sizes
    first = np.ones(len(codes), bool)
    first[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    i = np.flatnonzero(first)
    o = owner[i]
    cut = (total[i] - total[begin[o]]) + (total[end[o]] - total[i + 1]) * down[1]
    whole = total[end] - total[begin]
    keys = mix(np.concatenate([whole + sizes.astype(np.uint64), cut + (sizes[o] - 1).astype(np.uint64)]))
    return np.concatenate([np.arange(len(words)), o]), keys


def keyed(words: DataFrame) -> DataFrame:
    """id, key: from id, word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id").to_numpy()
            which, keys = delete_keys(b.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(ids[which]), pa.array(keys.view(np.int64))], names=["id", "key"])

    return words.select("id", "word").mapInArrow(run, "id bigint, key bigint")


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b: numbers of words that differ by exactly one code point, the lesser number first."""
    keys = materialise(keyed(words), "keys")
    shared = keys.groupBy("key").agg(F.count("*").alias("words")).where("words > 1").select("key")
    mine = keys.join(shared, "key")
    pairs = mine.withColumnRenamed("id", "a").join(mine.withColumnRenamed("id", "b"), "key").where("a < b").select("a", "b").distinct()
    for side in ("a", "b"):
        pairs = pairs.join(words.select(F.col("id").alias(side), F.col("word").alias(f"w{side}")), side)
    return pairs.where(F.levenshtein("wa", "wb", 1) == 1).select("a", "b")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the ends of forms (word, form; none null). A form has more occurrences than its word, so there is no cycle."""
    ends = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = ends.select(F.col("word").alias("root"), F.col("root").alias("far"))
        joined = materialise(ends.join(ahead, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "roots")
        ends = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            return ends


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n, from id, word, n."""
    c = F.col
    pairs = near_pairs(words)
    both = pairs.union(pairs.select(c("b").alias("a"), c("a").alias("b")))
    other = words.select(c("id").alias("b"), c("word").alias("near"), c("n").alias("near_n"))
    best = F.min(F.struct((-c("near_n")).alias("less"), "near")).alias("best")
    near = both.join(other, "b").groupBy(c("a").alias("id")).agg(F.count("*").alias("n_near"), best)
    joined = words.join(near, "id", "left")
    has = -c("best.less") >= ratio * c("n")
    named = materialise(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, c("best.near")).alias("form"), F.when(has, -c("best.less")).alias("form_n")), "forms")
    found = named.join(roots(named.where(c("form").isNotNull())), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, least_chars: int = LEAST_CHARS, least_times: int = LEAST_TIMES, ratio: int = RATIO, noise: int | None = NOISE) -> DataFrame:
    """One row a word: word, form, root, n, n_near, form_n."""
    return variants(vocabulary(docs, least_chars, least_times, noise), ratio)


def oracle() -> str:
    """DuckDB SQL. CRC-32 from its polynomial, near words as equal deletions at equal places or as a word's deletion."""
    return """
WITH RECURSIVE tbl AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(0, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS c FROM (SELECT unnest(range(0, 256)) AS i))),
o AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS w
  FROM documents),
k AS (SELECT id, w, count(*) AS times FROM o WHERE length(w) >= 6 GROUP BY id, w),
h AS (
  SELECT w, times, xor(list_reduce(list_transform(range(1, strlen(id || ':' || w) * 2, 2), lambda i: ('0x' || substr(hex(encode(id || ':' || w)), i::INTEGER, 2))::BIGINT),
                           lambda c, x: xor(c // 256, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM k, tbl),
v AS (
  SELECT row_number() OVER () AS id, word, n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, (h % length(w))::INTEGER) || substr(w, (h % length(w))::INTEGER + 2) ELSE w END AS word, sum(times)::BIGINT AS n
    FROM h GROUP BY 1) WHERE length(word) >= 6 AND n >= 5),
d AS (
  SELECT word, n, i::INTEGER AS i, substr(word, 1, i::INTEGER - 1) || substr(word, i::INTEGER + 1) AS cut
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM d a JOIN d b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.cut = v.word
  UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.cut = v.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word),
named AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 5 * v.n THEN b.m END AS form_n,
         CASE WHEN b.m >= 5 * v.n THEN (SELECT min(other) FROM near WHERE near.word = v.word AND near.m = b.m) END AS form
  FROM v LEFT JOIN best b ON v.word = b.word),
chain AS (
  SELECT word, word AS here, form AS next, 0 AS depth FROM named
  UNION ALL SELECT c.word, n.word, n.form, c.depth + 1 FROM chain c JOIN named n ON c.next = n.word),
ends AS (SELECT word, arg_max(here, depth) AS root FROM chain GROUP BY word)
SELECT n.word, n.form, e.root, n.n, n.n_near, n.form_n FROM named n JOIN ends e ON n.word = e.word
"""
