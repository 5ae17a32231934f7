"""Similarity of a repository's name and a paper's title, all of it in built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that don't count.
STOPWORDS = [
    "a", "an", "the", "for", "of", "on", "in", "with", "to", "and", "or", "is", "are", "was", "were", "be", "been", "being",
    "this", "that", "these", "those", "it", "its", "by", "from", "at", "as",
]
PUNCTUATION = r"""[!"#$%&'()*+,./:;<=>?@\[\\\]^`{|}~]"""


def tokens(c: Column) -> Column:
    """Distinct lower-case words, without punctuation and stopwords, sorted."""
    t = F.regexp_replace(F.translate(F.lower(F.coalesce(c, F.lit(""))), "-_", "  "), PUNCTUATION, "")
    return F.array_sort(F.array_except(F.array_distinct(F.split(t, r"(?U)\s+")), F.array(*[F.lit(w) for w in ["", *STOPWORDS]])))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b).otherwise(0.0)


def containment(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.greatest(_ratio(both, F.size(a)), _ratio(both, F.size(b)))


def jaccard(a: Column, b: Column) -> Column:
    return F.when((F.size(a) > 0) & (F.size(b) > 0), _ratio(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))).otherwise(0.0)


def _let(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Strings of so many characters fit the bits of a long, with room for a carry.
BITS = 60


def _lcs_bits(xs: Column, ys: Column, n: Column) -> Column:
    """Bit-parallel: a long holds the row of the table, each character of xs is one addition. ys has n characters, BITS at most."""
    power = lambda j: F.call_function("shiftleft", F.lit(1).cast("long"), j)
    places = lambda ch: F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0).cast("long"), lambda m, j: F.when(F.get(ys, j) == ch, m.bitwiseOR(power(j))).otherwise(m))
    masks = _let(F.array_distinct(ys), lambda d: F.map_from_arrays(d, F.transform(d, places)))
    full = power(n) - 1

    def fold(m: Column) -> Column:
        step = lambda v, ch: _let(v.bitwiseAND(F.coalesce(F.try_element_at(m, ch), F.lit(0).cast("long"))), lambda u: (v + u).bitwiseOR(v - u).bitwiseAND(full))
        return F.bit_count(F.aggregate(xs, full, step).bitwiseXOR(full))

    return _let(masks, fold)


def _lcs_blocks(xs: Column, ys: Column, n: Column) -> Column:
    """As `_lcs_bits`, for ys of any length: the row is in blocks of BITS places, a character of xs is one addition a block, and
    what an addition carries goes on to the next block."""
    zero = F.lit(0).cast("long")
    power = lambda j: F.call_function("shiftleft", F.lit(1).cast("long"), j)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BITS).cast("int")), lambda k: F.slice(ys, k * BITS + 1, BITS))
    places = lambda block, ch: F.aggregate(F.sequence(F.lit(0), F.size(block) - 1), zero, lambda m, j: F.when(F.get(block, j) == ch, m.bitwiseOR(power(j))).otherwise(m))

    def fold(all_blocks: Column) -> Column:
        full = F.transform(all_blocks, lambda b: power(F.size(b)) - 1)
        none = F.transform(all_blocks, lambda b: zero)
        masks = _let(F.array_distinct(ys), lambda d: F.map_from_arrays(d, F.transform(d, lambda ch: F.transform(all_blocks, lambda b: places(b, ch)))))

        def step(v: Column, mask: Column, f: Column) -> Column:
            def add(acc: Column, k: Column) -> Column:
                own = F.get(v, k)
                both = own.bitwiseAND(F.get(mask, k))
                total = own + both + acc["carry"]
                new = total.bitwiseOR(own - both).bitwiseAND(F.get(f, k))
                return F.struct(F.shiftright(total, BITS).alias("carry"), F.array_append(acc["v"], new).alias("v"))

            start = F.struct(zero.alias("carry"), F.array().cast("array<bigint>").alias("v"))
            return F.aggregate(F.sequence(F.lit(0), F.size(v) - 1), start, add, lambda acc: acc["v"])

        def count(t: Column) -> Column:
            end = F.aggregate(xs, t["full"], lambda v, ch: step(v, F.coalesce(F.try_element_at(t["masks"], ch), t["none"]), t["full"]))
            ones = F.zip_with(end, t["full"], lambda v, f: F.bit_count(v.bitwiseXOR(f)))
            return F.aggregate(ones, F.lit(0), lambda acc, k: acc + k)

        return _let(F.struct(full.alias("full"), none.alias("none"), masks.alias("masks")), count)

    return _let(blocks, fold)


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two strings."""
    chars = F.struct(F.split(F.when(F.length(a) < F.length(b), b).otherwise(a), "").alias("x"), F.split(F.when(F.length(a) < F.length(b), a).otherwise(b), "").alias("y"), F.least(F.length(a), F.length(b)).alias("n"))
    return _let(chars, lambda c: F.when(c["n"] == 0, F.lit(0)).when(c["n"] <= BITS, _lcs_bits(c["x"], c["y"], c["n"])).otherwise(_lcs_blocks(c["x"], c["y"], c["n"])))


def indel_ratio(a: Column, b: Column) -> Column:
    """1 - d / (|a| + |b|), d the insertions and deletions from a to b; 0 if either is empty."""
    total = F.length(a) + F.length(b)
    d = total - 2 * F.when((a == b) | (total == 0), F.length(a)).otherwise(lcs_length(a, b))
    return F.when((F.length(a) > 0) & (F.length(b) > 0), 1.0 - d.cast("double") / total).otherwise(0.0)


def name_match(repo: Column, title: Column, threshold: float = 0.45, weights: tuple[float, float, float] = (0.4, 0.4, 0.2)) -> Column:
    """struct: matched, score, containment, overlap, fuzzy, skip_reason."""
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    skip = F.when(~some(repo), F.lit("no_repo_name")).when(~some(title), F.lit("no_paper_title"))

    def parts(t: Column) -> Column:
        a, b = t["a"], t["b"]
        return F.struct(containment(a, b).alias("c"), jaccard(a, b).alias("o"), indel_ratio(F.array_join(a, " "), F.array_join(b, " ")).alias("f"))

    def result(p: Column) -> Column:
        score = weights[0] * p["c"] + weights[1] * p["o"] + weights[2] * p["f"]
        no = lambda x: F.when(skip.isNull(), x).otherwise(0.0)
        return F.struct((skip.isNull() & (score >= threshold)).alias("matched"), no(score).alias("score"), no(p["c"]).alias("containment"), no(p["o"]).alias("overlap"), no(p["f"]).alias("fuzzy"), skip.alias("skip_reason"))

    return _let(_let(F.struct(tokens(repo).alias("a"), tokens(title).alias("b")), parts), result)
