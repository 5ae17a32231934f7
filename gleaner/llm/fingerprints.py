"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text is a sequence of tokens, of the same kind at all lengths: what stands between single spaces or line ends, and
the code points of what is longer than `LONG` (scripts without spaces, links). Every k-mer is
labelled with its occurrence number, so that repeats count; the labelled k-mers are hashed and dealt into bins by their
hash (the one-permutation form of MinHash: one hash in place of one for each bin). Each bin selects its `2` least
hashes, puts them in text order, and hashes the ordered tuple. Moving passages about changes tuples even where the set
of k-mers stays the same: the signature follows edit distance and not only overlap.

Nulls count as empty texts. A text with fewer than k tokens is one k-mer. All work on one text is linear but for two
sorts of longs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, materialise, numbered

#: Stretches without a space that have more code points are taken by code points.
LONG = 16
#: What separates tokens besides the space.
GAPS = "\n\r\t\u00a0\u3000"
#: Low bits of a packed long hold the place in the text, the rest a hash.
POS = 26
_MASK = (1 << POS) - 1


def _pack(h: Column, pos: Column) -> Column:
    return h.bitwiseAND(F.lit(~_MASK)).bitwiseOR(pos.cast("long").bitwiseAND(F.lit(_MASK)))


def _hash(x: Column) -> Column:
    return F.shiftright(x, POS)


def tokens(text: Column) -> Column:
    words = F.split(F.translate(F.coalesce(text, F.lit("")), GAPS, " " * len(GAPS)), " ")
    long = lambda w: F.char_length(w) > LONG
    finer = lambda ws: F.flatten(F.transform(ws, lambda w: F.when(long(w), F.split(w, "")).otherwise(F.array(w))))
    return let(words, lambda ws: F.when(F.exists(ws, long), finer(ws)).otherwise(ws))


def kmers(words: Column, k: int) -> Column:
    """Sorted packed longs, one per k-mer: its hash, its place."""
    at = lambda w: F.sequence(F.lit(0), F.greatest(F.size(w) - F.lit(k), F.lit(0)))
    return let(words, lambda w: F.sort_array(F.transform(at(w), lambda i: _pack(F.xxhash64(*[F.get(w, i + F.lit(o)) for o in range(k)]), i))))


def labelled_repeats(s: Column) -> Column:
    """The k-mers of a sorted array that occurred before, under a hash of (k-mer, occurrence number), sorted. Its first
    occurrence keeps the k-mer's own hash, so that most texts have little to relabel."""
    again = F.filter(s, lambda x, i: (i > 0) & (_hash(F.get(s, i - 1)) == _hash(x)))

    def numbered_runs(r):
        starts = F.filter(F.sequence(F.lit(0), F.size(r) - 1), lambda i: (i == 0) | (_hash(F.get(r, i)) != _hash(F.get(r, i - 1))))
        numbers = let(starts, lambda v: F.flatten(F.transform(v, lambda at, j: F.sequence(F.lit(1), F.coalesce(F.get(v, j + 1), F.size(r)) - at))))
        return F.sort_array(F.zip_with(r, numbers, lambda x, o: _pack(F.xxhash64(_hash(x), o), x)))

    return let(again, lambda r: F.when(F.size(r) == 0, r).otherwise(numbered_runs(r)))


def order_minhash(text: Column, k: int = 3, bins: int = 32) -> Column:
    """array<bigint>: for each bin that has a k-mer, bin << 32 | 32-bit hash of its tuple, ascending by bin."""
    width = bins.bit_length() - 1
    if bins != 1 << width or not 1 <= width <= 6:
        raise ValueError("bins must be a power of two from 2 to 64")
    bin_of = lambda x: F.shiftright(x, 64 - width)  # noqa: E731  the arrays are sorted, so bins are runs

    def least(s):
        return F.filter(s, lambda x, i: (i < 2) | (bin_of(F.get(s, i - 2)) != bin_of(x)))

    def selected(s):
        firsts = F.filter(s, lambda x, i: (i == 0) | (_hash(F.get(s, i - 1)) != _hash(x)))
        few = lambda v: let(v, least)
        return let(firsts, lambda f: F.when(F.size(f) == F.size(s), least(f)).otherwise(few(F.sort_array(F.concat(least(f), few(labelled_repeats(s)))))))

    def tuples(s):
        def one(x, i):
            y = F.when(bin_of(F.get(s, i + 1)) == bin_of(x), F.get(s, i + 1))
            forward = x.bitwiseAND(F.lit(_MASK)) < y.bitwiseAND(F.lit(_MASK))
            h = F.when(y.isNull(), F.xxhash64(_hash(x))).when(forward, F.xxhash64(_hash(x), _hash(y))).otherwise(F.xxhash64(_hash(y), _hash(x)))
            entry = F.shiftleft(bin_of(x).bitwiseAND(F.lit(bins - 1).cast("long")), 32).bitwiseOR(h.bitwiseAND(F.lit(0xFFFFFFFF)))
            return F.when((i == 0) | (bin_of(F.get(s, i - 1)) != bin_of(x)), entry)

        return F.sort_array(F.array_compact(F.transform(s, one)))

    return let(let(kmers(tokens(text), k), selected), tuples)


def likeness(a: Column, b: Column) -> Column:
    """Bins with equal tuples, as a part of the bins that either text fills: 0 to 1."""
    bins = lambda x: F.transform(x, lambda v: F.shiftright(v, 32))
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(bins(a), bins(b)))


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), 10, "0")), "")


def edited_and_next(docs: DataFrame, k: int = 3, bins: int = 32) -> DataFrame:
    """Fingerprints of every text, of its edited text (the last quarter gives way to the start of the next document)
    and their likenesses. Rows that repeat a doc_id count once, with the least text; a null doc_id comes first.

    Texts are shuffled by id once; this one exchange serves both joins. Only ids are numbered."""
    least = -(1 << 63)
    key = F.coalesce(F.col("doc_id"), F.lit(least)).alias("id")
    quarter = F.floor(F.char_length(F.coalesce(F.col("text"), F.lit(""))) / 4).cast("int")
    ids, n = numbered(docs.select(key, quarter.alias("need")).groupBy("id").agg(F.max("need").alias("need")), [F.col("id")], "doc-order")
    if not n:
        return docs.select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in (("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double"))]).limit(0)
    after = ids.select(F.col("id").alias("next_id"), F.pmod(F.col("idx") - 1, F.lit(n)).alias("idx"))
    links = materialise(ids.join(after, "idx").select("id", "need", "next_id"), "doc-links")

    t = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(key, t.alias("text")).withColumn("fp", order_minhash(F.col("text"), k, bins))
    from pyspark.sql import Window

    once = texts.withColumn("__n", F.row_number().over(Window.partitionBy("id").orderBy("text"))).where("__n = 1").drop("__n")
    following = once.select(F.col("id").alias("next_id"), "text", F.col("fp").alias("next_fp"))
    ahead = links.join(following, "next_id").select("id", "next_fp", F.substring("text", F.lit(1), F.col("need")).alias("next_text"))
    whole = once.join(ahead, "id")
    n_chars = F.char_length("text").cast("long")
    tail = F.floor(n_chars / 4).cast("int")
    out = whole.withColumn("n_chars", n_chars).withColumn("edited", F.concat(F.substring("text", F.lit(1), n_chars.cast("int") - tail), F.substring("next_text", F.lit(1), tail))).drop("text", "next_text")
    out = out.withColumn("efp", order_minhash(F.col("edited"), k, bins))
    return out.select(
        F.when(F.col("id") != least, F.col("id")).alias("doc_id"), "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
