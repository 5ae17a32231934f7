"""Near-duplicate documents by Order MinHash and banded alignment.

A text is its lower-case words. Every five-word shingle gets an occurrence number; each of `TUPLES` hash functions
selects the two least labelled shingles of the text, which are put in text order and hashed: one key a function. Texts
that share a key are candidates. A link is a candidate pair that banded alignment of the words finds alike: edit similarity
(1 - distance / longer length) of 0.8 or more. Linked documents form a class.

Not all pairs of a key are compared, as a passage that many texts share makes large keys of texts that are not alike:

* In keys of up to `SMALL` texts, all pairs are compared.
* A larger key has a leader (its first or last node by turns), and a text stands against the `LEADERS` leaders that most of
  its keys name. In keys whose members are not yet of one class, the member with the most links leads next, which is the
  middle of a star.
* What is left of larger keys goes through a join that is exact for edit similarity: of two texts at 0.8 or more, one word is
  among the rarest fifth (and one more) of each, by any one order of all words (numbered by occurrence). Texts that share such
  a word meet in blocks, and what two bags of words rule out never leaves the task. What is left leaves it as lists, one for
  two blocks of all texts (`ROOM` each); the texts of two blocks are copied once for all their pairs and are aligned where they
  meet, so that links alone come out. Of two classes, the pairs with most in common are aligned first; where a task held some
  back and the classes are still two, the texts of these meet again, and all their pairs are aligned. So every pair that shares
  a key, small or large, and is alike ends in one class.

Before texts are sent, counts of words in `BAG` slots rule out pairs that have too few words in common.

Exact copies are one node from the start: their texts are compared once. Nodes have numbers, which all tables of keys, pairs
and labels carry in place of texts. Nulls count as empty texts; texts without a
word are in a class with their exact copies only. Rows that repeat a doc_id with another text are nodes of their own; a
null doc_id never names a class that has another. Every row is returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .words import hash_words, mix

WORDS, TUPLES, LEAST = 5, 80, 0.8
SMALL, LEADERS, BAG = 8, 3, 256
#: Slots of the bags that sift texts which share a rare word: such texts are many, and near the threshold.
FINE = 1024
#: So many texts that share a rare word meet as many others in one task.
BLOCK = 512
#: A row of a rare word carries so many of its text's rarer words, those next to it in order.
BEFORE = 32
#: A task gives out so many pairs at a time.
HELD = 1 << 20
#: So many pairs of two classes leave a task in the first pass; what is held back is dealt with in the second.
FIRST = 1024
#: So many texts, about, are a block of those that are aligned where they meet.
ROOM = 1024
#: So many pairs share one copy of a text that is sent to them.
FAN = 256
_PLACE = np.uint64((1 << 24) - 1)
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def node(text: str = "text") -> Column:
    """A text's identity: 16 bytes."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles (one of all words for shorter texts, none without words), and how many each text has."""
    begin = np.concatenate([[0], np.cumsum(counts)])
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[:-1], n)
    ends = np.repeat(begin[1:], n)
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    out = np.zeros(len(at), np.uint64)
    for o in range(k):
        word = padded[at + o]
        out = out * np.uint64(0x9DDFEA08EB382D69) + np.where(at + o < ends, word, np.uint64(o))
    return mix(out), n


def labels(kmers: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each shingle hashed with its occurrence number in its text."""
    owner = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    key = kmers + mix(owner + np.uint64(1))
    order = np.argsort(key, kind="stable")
    s = key[order]
    first = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
    run = np.maximum.accumulate(np.where(first, np.arange(len(s)), 0)) if len(s) else np.zeros(0, int)
    number = np.empty(len(s), np.uint64)
    number[order] = (np.arange(len(s)) - run).astype(np.uint64)
    return mix(kmers + number * np.uint64(0xC2B2AE3D27D4EB4F))


def order_tuples(texts: list[str | None], k: int = WORDS, tuples: int = TUPLES) -> np.ndarray:
    """texts x tuples: the keys; rows of texts without words are 0."""
    return tuples_of(*hash_words(texts), k, tuples)


def tuples_of(hashes: np.ndarray, counts: np.ndarray, k: int, tuples: int) -> np.ndarray:
    kmers, n = shingles(hashes, counts, k)
    out = np.zeros((len(counts), tuples), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    lab = labels(kmers, n)
    begin = (np.cumsum(n) - n)[full]
    place = (np.arange(len(lab)) - np.repeat(begin, n[full])).astype(np.uint64) & _PLACE
    for t in range(tuples):
        seed = mix(np.array([2 * t + 1, 2 * t + 2], np.uint64))
        v = ((lab ^ seed[0]) * (seed[1] | np.uint64(1)) & ~_PLACE) | place
        one = np.minimum.reduceat(v, begin)
        i = _where(v, one, begin, n[full])
        v[i] = _MOST
        two = np.minimum.reduceat(v, begin)
        j = np.where(two == _MOST, i, _where(v, two, begin, n[full]))
        a, b = lab[np.minimum(i, j)], lab[np.maximum(i, j)]
        out[full, t] = mix(a * np.uint64(0x9FB21C651E98DF25) + b + np.uint64(t))
    return out


def _where(v: np.ndarray, least: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The place of each run's least value; it is in the value's low bits, unless the text is longer than these hold."""
    i = begin + (least & _PLACE).astype(np.int64)
    for r in np.flatnonzero(n > int(_PLACE)):
        i[r] = begin[r] + int(v[begin[r] : begin[r] + n[r]].argmin())
    return i


def banded_distance(a: list[int], b: list[int], most: int) -> int:
    """Edit distance if it is `most` at most, else some number beyond. The band of 2 * most + 1 diagonals moves down by one
    row a column and is held as bits of vertical differences (Hyyro's form of Myers' algorithm)."""
    if len(a) < len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if m - n > most:
        return most + 1
    if not n:
        return m
    rows: dict[int, int] = {}
    for i, x in enumerate(a):
        rows[x] = rows.get(x, 0) | 1 << i
    full = (1 << (2 * most + 1)) - 1
    own = 1 << (m - n + most)
    up = full ^ ((1 << most) - 1)  # rows of the matrix; those above it have no difference
    down, score = 0, m - n
    for j, y in enumerate(b):
        x = rows.get(y, 0)
        x = (x >> (j - most) if j >= most else x << (most - j)) & full
        d = ((((x & up) + up) ^ up) | x | down) & full
        hp = down | (full & ~(d | up))
        hn = d & up
        if not d & own:
            score += 1
            if score > most:
                return score
        up = hn | (full & ~((d >> 1) | hp))
        down = (d >> 1) & hp
    return score


def alike(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> bool:
    """Edit similarity of two sequences of word hashes at `least` or above."""
    longest = max(len(a), len(b))
    if not longest:
        return True
    most = int((1 - least) * longest + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b, n = a[head:], b[head:], n - head
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return max(len(a), len(b)) <= most
    both, times = np.unique(np.concatenate([a, b]), return_inverse=True)
    common = np.minimum(np.bincount(times[: len(a)], minlength=len(both)), np.bincount(times[len(a) :], minlength=len(both))).sum()
    if max(len(a), len(b)) - common > most:
        return False
    return banded_distance(a.tolist(), b.tolist(), most) <= most


def _blocks(texts: list[str | None], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about so many code points: working memory is many times the text."""
    i = 0
    while i < len(texts):
        j, held = i, 0
        while j < len(texts) and (j == i or held + len(texts[j] or "") <= size):
            held += len(texts[j] or "")
            j += 1
        yield i, j
        i = j


def sketches(docs: DataFrame, k: int = WORDS, tuples: int = TUPLES) -> DataFrame:
    """doc_id, node, n (words), keys (none for texts without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            found, sizes = [], []
            for i, j in _blocks(texts):
                hashes, counts = hash_words(texts[i:j])
                found += [x.view(np.int64).tolist() if x.any() else [] for x in tuples_of(hashes, counts, k, tuples)]
                sizes += counts.tolist()
            columns = [b.column("doc_id"), b.column("node"), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "n", "keys"])

    return docs.select("doc_id", node().alias("node"), "text").mapInArrow(run, "doc_id bigint, node binary, n bigint, keys array<bigint>")


def numbered_nodes(found: DataFrame) -> DataFrame:
    """id, node, rep (the least doc_id), rows, n, keys: one row a text."""
    each = found.groupBy("node").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    return materialise(each.select(F.monotonically_increasing_id().alias("id"), "*"), "nodes")


def members(nodes: DataFrame) -> DataFrame:
    """key, id, size, leader: the texts of every key that two texts or more have, and the key's first leader."""
    each = nodes.select("id", F.explode("keys").alias("key"))
    ends = each.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("size")).where("size > 1")
    even = F.col("key").bitwiseAND(F.lit(1)) == 0
    return each.join(ends, "key").select("key", "id", "size", F.when(even, F.col("lo")).otherwise(F.col("hi")).alias("leader"))


def _near(a: str, b: str, least: float) -> Column:
    """Whether texts of so many words can be alike at all."""
    return F.abs(F.col(a) - F.col(b)) <= F.floor((1 - least) * F.greatest(a, b) + F.lit(1e-9))


def _ordered(found: DataFrame) -> DataFrame:
    """Pairs, the lesser number first."""
    return found.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _best(named: DataFrame, rank: str) -> DataFrame:
    """a, b: pairs of each id with the leaders that rank highest for it, `LEADERS` at most. named: id, leader, rank."""
    top = F.slice(F.sort_array(F.collect_list(F.struct(rank, "leader")), asc=False), 1, LEADERS)  # a text has TUPLES keys at most
    return _ordered(named.groupBy("id").agg(top.alias("top")).select(F.col("id").alias("b"), F.explode("top.leader").alias("a")))


def candidates(each: DataFrame, small: int = SMALL) -> DataFrame:
    """a, b: all pairs of a small key, and pairs of a text and the leaders that most of its larger keys name."""
    group = each.where(F.col("size") <= small).groupBy("key").agg(F.collect_list("id").alias("g"))  # `small` members at most
    pairs = group.select("g", F.explode("g").alias("a")).select("a", F.explode("g").alias("b")).where("a < b")
    others = each.where((F.col("size") > small) & (F.col("id") != F.col("leader"))).select("id", "leader")
    named = others.repartition("id").groupBy("id", "leader").agg(F.count("*").alias("keys"))  # dealt once, for both groupings
    return pairs.union(_best(named, "keys")).distinct()


def unsettled(each: DataFrame, label: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """key, id, size, label, first (the member with the most links, and its label; any member without `links`) of the keys
    whose members are of two classes or more. Each join by key is written at once, so that Spark can split a hot one."""
    known = label.withColumn("links", F.lit(0))
    if links is not None:
        degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("links"))
        known = label.join(degree, "id", "left")
    columns = ["key", "id", "size", F.coalesce("label", "id").alias("label"), F.coalesce("links", F.lit(0)).alias("links")]
    now = materialise(each.select("key", "id", "size").join(known, "id", "left").select(*columns), "labelled")
    first = F.max(F.struct("links", "id", "label")).alias("first")
    mixed = now.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), first).where("lo != hi").select("key", "first")
    return materialise(now.drop("links").join(mixed, "key"), "unsettled")


def led(left: DataFrame, tested: DataFrame) -> DataFrame:
    """a, b: untested pairs of a text and those members of its keys, of another class, that have the most links."""
    named = left.where(F.col("label") != F.col("first.label")).select("id", F.col("first.id").alias("leader"), F.col("first.links").alias("links")).repartition("id").distinct()
    return _best(named, "links").distinct().join(tested, ["a", "b"], "left_anti")


def prefixes(texts: DataFrame, rest: DataFrame, least: float = LEAST) -> DataFrame:
    """id, n (words), bag (of `FINE` slots), rare (word, and how many texts have it): the rarest numbered words of each text in rest that one of a
    pair at edit similarity `least` must share. So many edits as such a pair may have touch so many words of the longer text at
    most; with one word more, one of these is left in both. Words that one text only has come first in that order; they match
    nothing and are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column("t").to_pylist()
            flat, sizes, bags = [np.zeros(0, np.uint64)], [0], []
            for i, j in _blocks(words):
                hashes, counts = hash_words(words[i:j])
                flat.append(labels(hashes, counts))
                sizes += counts.tolist()
                bags += [x.tobytes() for x in _bags(hashes, counts, FINE)]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.concatenate(flat).view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n"), pa.array(bags, pa.binary()), lists], names=["id", "n", "bag", "words"])

    mine = texts.join(rest, "id").select("id", "n", "t")
    made = materialise(mine.mapInArrow(run, "id bigint, n bigint, bag binary, words array<bigint>"), "words")
    each = made.select("id", F.explode("words").alias("word"))
    shared = each.groupBy("word").agg(F.count("*").alias("texts")).where("texts > 1")
    ordered = each.join(shared, "word").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("texts", "word"))).alias("g"))  # the words of one text
    known = ordered.join(made.select("id", "n", "bag"), "id")
    count = F.floor((1 - least) * F.col("n") + F.lit(1e-9)) + 1 - (F.col("n") - F.size("g"))
    rare = F.slice("g", F.lit(1), F.greatest(count, F.lit(0)).cast("int"))
    return materialise(known.select("id", "n", "bag", rare.alias("rare")), "rare")


def rare_pairs(prefix: DataFrame, label: DataFrame, tested: DataFrame, least: float = LEAST, best: int | None = None, block: int = BLOCK) -> DataFrame:
    """a, b: the pairs of `rare_lists`, but for those tested."""
    lists = rare_lists(prefix, label, 1, least, best, block)
    return _ordered(lists.select(F.explode(F.arrays_zip("a", "b")).alias("p")).select("p.a", "p.b")).distinct().join(tested, ["a", "b"], "left_anti")


def rare_lists(prefix: DataFrame, label: DataFrame, rooms: int, least: float = LEAST, best: int | None = None, block: int = BLOCK) -> DataFrame:
    """x, y, a, b, lack, more: pairs of two classes (label: id, label) that share one of their rarest words and whose bags allow
    that they are alike, and how many words these lack; with `best`, for two classes only so many in a task, those that have most
    in common, and whether the task has more pairs of these classes. Pairs are in lists, all of two of the `rooms` blocks of texts in one (of each task and `HELD` pairs). Texts of a
    word are dealt into blocks of about `block`, and two blocks at a time meet in a task, so that no task holds all texts of a
    word. Pairs are made and sifted there; only those that are left leave it. A pair leaves at the first word that both have,
    and at a later one only if the words before it within reach (`BEFORE` of them) are not common to both: it is never held
    back everywhere."""
    c = F.col
    each = prefix.join(label, "id").select("id", "label", "n", "bag", "rare", F.posexplode("rare").alias("p", "g"))
    before = F.slice("rare.word", F.greatest(c("p") - BEFORE, F.lit(0)) + 1, F.least(c("p"), F.lit(BEFORE)))
    each = each.select("id", "label", "n", "bag", "g", before.alias("before"))
    own = each.withColumn("parts", F.ceil(c("g.texts") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("id"), c("parts")).cast("int"))
    both = own.withColumn("other", F.explode(F.sequence(F.lit(0), c("parts") - 1)))
    columns = [c("g.word").alias("word"), F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "id", "label", "n", "bag", "before"]
    met = both.select(*columns).repartition("word", "x", "y").sortWithinPartitions("word", "x", "y")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found = None, np.zeros((0, 6), np.int64)
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            last = int(_groups(rows)[1][-1]) if len(rows) else 0  # the last group may go on in the next batch
            found = _distinct(np.concatenate([found, _sifted(rows.slice(0, last), least)]), best)
            held = rows.slice(last)
            if len(found) > HELD:
                yield _batch(found, rooms)
                found = found[:0]
        if held is not None:
            found = np.concatenate([found, _sifted(held, least)])
        yield _batch(_distinct(found, best), rooms)

    return met.mapInArrow(sift, "x bigint, y bigint, a array<bigint>, b array<bigint>, lack array<bigint>, more array<boolean>")


def _batch(pairs: np.ndarray, rooms: int) -> pa.RecordBatch:
    """Rows of `_distinct` as lists, one for two blocks of texts."""
    ends = np.sort(pairs[:, 3:5], axis=1)
    of = np.sort((mix(ends.astype(np.uint64)) % np.uint64(rooms)).astype(np.int64), axis=1)
    order = np.lexsort((of[:, 1], of[:, 0]))
    ends, of, lack, more = ends[order], of[order], pairs[order, 2], pairs[order, 5] > 0
    first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]).any(axis=1)])) if len(of) else np.zeros(0, np.int64)
    at = pa.array(np.append(first, len(of)), pa.int32())
    lists = [pa.ListArray.from_arrays(at, pa.array(np.ascontiguousarray(v))) for v in (ends[:, 0], ends[:, 1], lack, more)]
    return pa.RecordBatch.from_arrays([*[pa.array(np.ascontiguousarray(of[first, i]), pa.int64()) for i in (0, 1)], *lists], names=["x", "y", "a", "b", "lack", "more"])


def aligned(lists: DataFrame, done: DataFrame | None, texts: DataFrame, label: DataFrame, least: float = LEAST) -> DataFrame:
    """a, b: links between the texts of lists (as `rare_lists` has them, `done` being the lists that were aligned before). The
    texts of two blocks meet once, whatever the number of their pairs, and are aligned there, those with most words in common
    first; a pair whose classes have been linked there before needs no alignment. So of so many classes, fewer links come out."""
    ids = lists.select("x", "y", F.array_distinct(F.concat("a", "b")).alias("ids")).groupBy("x", "y").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids"))  # the ids of two blocks
    copied = ids.select("x", "y", F.explode("ids").alias("id")).join(texts.select("id", "t"), "id").join(label, "id").select("x", "y", "id", "label", "t").toDF("u", "v", "id", "label", "t")
    given = lists.drop("more").withColumn("done", F.lit(False))
    given = given if done is None else given.union(done.drop("more").withColumn("done", F.lit(True)))

    def check(pairs: pa.Table, mine: pa.Table) -> pa.Table:
        past, now = (_flattened(pairs.filter(pairs.column("done") if old else pc.invert(pairs.column("done")))) for old in (True, False))
        past = set(map(tuple, past[:, 1:].tolist()))
        ids, t = mine.column("id").to_pylist(), mine.column("t").to_pylist()
        of, words, top = dict(zip(ids, mine.column("label").to_pylist(), strict=True)), {}, {}
        for i, j in _blocks(t):
            hashes, counts = hash_words(t[i:j])
            words.update(zip(ids[i:j], np.split(hashes, np.cumsum(counts)[:-1]), strict=True))

        def end(x: int) -> int:
            while x in top:
                x = top[x]
            return x

        links = []
        for _, a, b in now.tolist():
            x, y = end(of[a]), end(of[b])
            if x != y and (a, b) not in past and alike(words[a], words[b], least):
                top[max(x, y)] = min(x, y)
                links.append((a, b))
        return pa.table({k: pa.array([p[i] for p in links], pa.int64()) for i, k in enumerate("ab")})

    return given.groupBy("x", "y").cogroup(copied.groupBy("u", "v")).applyInArrow(check, "a bigint, b bigint")


def _flattened(lists: pa.Table) -> np.ndarray:
    """Rows of lack, a, b: each pair once, least lack first."""
    rows = np.stack([lists.column(k).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64) for k in ("a", "b", "lack")], axis=1)
    rows = np.unique(rows, axis=0)
    return rows[np.argsort(rows[:, 2], kind="stable")][:, [2, 0, 1]]


def _distinct(pairs: np.ndarray, best: int | None) -> np.ndarray:
    """Rows of two labels, words that the bags lack, two ids, and whether pairs of these labels have been left out: once each,
    and the first `best` of two labels."""
    rows = np.unique(pairs, axis=0)
    if best is None or not len(rows):
        return rows
    again = np.concatenate([[False], (rows[1:, :5] == rows[:-1, :5]).all(axis=1)])
    new = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
    of, at = np.cumsum(new) - 1, np.cumsum(~again)  # the two labels' number, the pair's
    beyond = at - at[np.flatnonzero(new)][of] >= best
    rows[:, 5] = np.bincount(of, weights=(rows[:, 5] > 0) | beyond)[of] > 0
    return rows[~again & ~beyond]


def _groups(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's group (equal word, x and y in sorted rows), and where each group starts."""
    keys = [rows.column(k).to_numpy() for k in ("word", "x", "y")]
    new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]) if len(rows) else np.zeros(0, bool)
    return np.cumsum(new), np.flatnonzero(new)


def _before(rows: pa.Table, word: np.ndarray) -> np.ndarray:
    """rows x BEFORE: the words before each row's own one, filled up with that word (which is in no such list)."""
    lists = rows.column("before").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.repeat(word[:, None], BEFORE, axis=1)
    out[np.arange(BEFORE) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _met_before(a: np.ndarray, b: np.ndarray, word: np.ndarray, step: int = 512) -> np.ndarray:
    """Whether two rows of a word have a word before it in common."""
    out = np.zeros(len(a), bool)
    for i in range(0, len(a), step):
        x, y, w = a[i : i + step], b[i : i + step], word[i : i + step, None]
        out[i : i + step] = ((x[:, :, None] == y[:, None, :]) & (x != w)[:, :, None]).any(axis=(1, 2))
    return out


def _sifted(rows: pa.Table, least: float, step: int = 8192) -> np.ndarray:
    """Pairs of a group that may be alike, as `_distinct` takes them: each row and the one `off` places on, for all groups at
    once."""
    group, _ = _groups(rows)
    own, label, n, ids = (rows.column(k).to_numpy() for k in ("own", "label", "n", "id"))
    alone = (rows.column("x").to_numpy() == rows.column("y").to_numpy()) if len(rows) else np.zeros(0, bool)
    fine = np.frombuffer(b"".join(rows.column("bag").to_pylist()), np.uint8).reshape(-1, FINE)
    bags = np.minimum(fine.reshape(-1, FINE // BAG, BAG).sum(axis=1, dtype=np.int64), 255).astype(np.uint8)  # at a quarter of the work
    word = rows.column("word").to_numpy()
    before = _before(rows, word)
    found, i, off = [], np.arange(len(rows)), 1
    while len(i := i[i + off < len(rows)]) and len(i := i[group[i] == group[i + off]]):
        j = i + off
        longest = np.maximum(n[i], n[j])
        near = np.abs(n[i] - n[j]) <= np.floor((1 - least) * longest + 1e-9)
        some = i[near & (label[i] != label[j]) & (alone[i] | (own[i] != own[j]))]
        for at in range(0, len(some), step):
            p, q = some[at : at + step], some[at : at + step] + off
            for level in (bags, fine):
                lack = bags_lack(level[p], level[q], n[p], n[q])
                fit = lack <= np.floor((1 - least) * np.maximum(n[p], n[q]) + 1e-9)
                p, q, lack = p[fit], q[fit], lack[fit]
            new = ~_met_before(before[p], before[q], word[p])
            p, q, lack = p[new], q[new], lack[new]
            swap = label[p] > label[q]
            p, q = np.where(swap, q, p), np.where(swap, p, q)
            found.append(np.stack([label[p], label[q], lack, ids[p], ids[q], np.zeros_like(p)], axis=1))
        off += 1
    return np.unique(np.concatenate([np.zeros((0, 6), np.int64), *found]), axis=0)


def links(nodes: DataFrame, docs: DataFrame, least: float = LEAST) -> DataFrame:
    """id, label: the classes of the texts that have links."""
    each = materialise(members(nodes), "members")
    texts = texts_of(docs, nodes, each)
    tested = materialise(candidates(each), "candidates")
    found = materialise(verified(sifted(tested, texts, least), texts, least), "verified")
    label = components(found)
    left = unsettled(each.where(F.col("size") > SMALL), label, found)
    new = materialise(led(left, tested), "candidates")
    if not new.isEmpty():
        label = relabelled(label, materialise(verified(sifted(new, texts, least), texts, least), "verified"))
        left = unsettled(left.select("key", "id", "size"), label)  # a key that is settled stays so

    mine = materialise(left.select("id", "label").distinct(), "rest")
    if mine.isEmpty():
        return label
    prefix, rooms = prefixes(texts, mine.select("id"), least), -(-mine.count() // ROOM)
    lists = materialise(rare_lists(prefix, mine, rooms, least, FIRST), "met")
    label = relabelled(label, materialise(aligned(lists, None, texts, mine, least), "verified"))
    again = cut_short(lists, mine, label)
    if again is None:
        return label
    more = materialise(rare_lists(prefix, again, rooms, least), "met")
    return relabelled(label, materialise(aligned(more, lists, texts, again, least), "verified"))


def cut_short(lists: DataFrame, mine: DataFrame, label: DataFrame) -> DataFrame | None:
    """id, label: the texts of `mine` in classes that are still two and of whose pairs some task gave out the first only. Of
    all other classes every pair that was left by the sift is in the lists. None if there are none."""
    cut = lists.where(F.exists("more", lambda x: x)).select(F.explode(F.arrays_zip("a", "b", "more")).alias("p")).where("p.more").select("p.a", "p.b").distinct()
    if cut.isEmpty():
        return None
    now = materialise(mine.select("id").join(label, "id", "left").select("id", F.coalesce("label", "id").alias("label")), "rest")
    two = cut.join(now.toDF("a", "la"), "a").join(now.toDF("b", "lb"), "b").where("la != lb")
    open_ = materialise(two.select(F.explode(F.array("la", "lb")).alias("label")).distinct(), "open")
    return None if open_.isEmpty() else materialise(now.join(open_, "label", "left_semi").select("id", "label"), "rest")


def relabelled(label: DataFrame, more: DataFrame) -> DataFrame:
    """id, label: classes that one of the links `more` joins are one. Only links between classes are followed."""
    if more.isEmpty():
        return label
    ids = more.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    ends = materialise(ids.join(label, "id", "left").select("id", F.coalesce("label", "id").alias("label"), F.isnull("label").alias("alone")), "ends")
    of = ends.select("id", "label")
    drawn = _ordered(more.join(of.toDF("a", "la"), "a").join(of.toDF("b", "lb"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b")))
    top = components(materialise(drawn, "drawn")).toDF("label", "end")
    known = label.union(ends.where("alone").select("id", "label"))
    return materialise(known.join(top, "label", "left").select("id", F.coalesce("end", "label").alias("label")), "labels")


def texts_of(docs: DataFrame, nodes: DataFrame, each: DataFrame) -> DataFrame:
    """id, n, bag, t: the texts of the nodes that share a key, each read from the row with its least doc_id."""
    # One column names a node's row in docs, so that what is joined by it is dealt by it.
    row = lambda node, doc_id: F.concat_ws(" ", F.hex(node), F.coalesce(doc_id.cast("string"), F.lit("null")))
    need = nodes.select("id", "n", row(F.col("node"), F.col("rep")).alias("row")).join(each.select("id").distinct(), "id")
    mine = docs.select(row(node(), F.col("doc_id")).alias("row"), F.coalesce("text", F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column("t").to_pylist()
            bags = [x.tobytes() for i, j in _blocks(words) for x in bags_of(words[i:j])]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n"), pa.array(bags, pa.binary()), b.column("t")], names=["id", "n", "bag", "t"])

    once = mine.join(need, "row").dropDuplicates(["row"]).select("id", "n", "t")
    return materialise(once.mapInArrow(run, "id bigint, n bigint, bag binary, t string"), "texts")


def bags_of(texts: list[str], slots: int = BAG) -> np.ndarray:
    """How many words of each text fall in each slot, 255 at most."""
    return _bags(*hash_words(texts), slots)


def _bags(hashes: np.ndarray, counts: np.ndarray, slots: int) -> np.ndarray:
    owner = np.repeat(np.arange(len(counts)), counts)
    flat = np.bincount(owner * slots + (hashes >> np.uint64(32)).astype(np.int64) % slots, minlength=len(counts) * slots)
    return np.minimum(flat, 255).astype(np.uint8).reshape(-1, slots)


def bags_lack(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """So many edits, at least, two texts are apart: words of the longer one beyond those in common in each slot. What full
    slots could not count counts as in common as far as both texts have such words."""
    common = np.minimum(a, b).sum(axis=1, dtype=np.int64)
    beyond = [n - x.sum(axis=1, dtype=np.int64) for x, n in ((a, na), (b, nb))]
    return np.maximum(na, nb) - common - np.minimum(*beyond)


def bags_allow(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, least: float = LEAST) -> np.ndarray:
    """False for pairs that need more edits than alike texts have."""
    return bags_lack(a, b, na, nb) <= np.floor((1 - least) * np.maximum(na, nb) + 1e-9)


def sifted(pairs: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs whose lengths and bags allow that they are alike."""
    ends = texts.select("id", "n", "bag")
    sized = pairs.join(ends.toDF("a", "na", "ga"), "a").join(ends.toDF("b", "nb", "gb"), "b").where(_near("na", "nb", least))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, BAG) for k in ("ga", "gb")]
            sizes = [batch.column(k).to_numpy() for k in ("na", "nb")]
            yield batch.select(["a", "b"]).filter(pa.array(bags_allow(*bags, *sizes, least), pa.bool_()))

    return materialise(sized.select("a", "b", "na", "nb", "ga", "gb").mapInArrow(sift, "a bigint, b bigint"), "likely")


def verified(likely: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs (sifted ones) whose texts are alike. A text that is in many pairs (a leader) is copied once for `FAN` of them,
    and its pairs are dealt to these copies, so that no task holds all pairs of one text."""
    ends = likely.select(F.explode(F.array("a", "b")).alias("id"))
    degree = ends.groupBy("id").agg(F.ceil(F.count("*") / FAN).cast("int").alias("copies"))
    degree = materialise(degree, "degree")
    known = likely.join(degree.toDF("a", "ka"), "a").join(degree.toDF("b", "kb"), "b")
    dealt = known.select("a", "b", *[F.pmod(F.xxhash64(other), k).cast("int").alias(s) for s, k, other in (("sa", "ka", "b"), ("sb", "kb", "a"))])
    copied = texts.select("id", "t").join(degree, "id").select("id", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("s"), "t")
    for side in ("a", "b"):
        dealt = dealt.join(copied.toDF(side, f"s{side}", f"t{side}"), [side, f"s{side}"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ta, tb = batch.column("ta").to_pylist(), batch.column("tb").to_pylist()
            once = list(dict.fromkeys(ta + tb))
            words = {}
            for i, j in _blocks(once):
                hashes, counts = hash_words(once[i:j])
                words.update(zip(once[i:j], np.split(hashes, np.cumsum(counts)[:-1]), strict=True))
            keep = [alike(words[x], words[y], least) for x, y in zip(ta, tb, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return dealt.select("a", "b", "ta", "tb").mapInArrow(check, "a bigint, b bigint")


def components(pairs: DataFrame) -> DataFrame:
    """id, label: the least id that links reach. Each round, every id points to its least neighbour; these pointers are
    followed to their ends (twice as far each time), and the links are drawn between the ends. Links within an end's own
    ids are gone by then, so that rounds get shorter; every step is a table in the shared folder."""
    links, label = pairs.select("a", "b"), None
    while label is None or not links.isEmpty():
        both = links.union(links.select("b", "a")).toDF("id", "to")
        end = materialise(both.groupBy("id").agg(F.min("to").alias("m")).select("id", F.least("id", "m").alias("end")), "ends")
        while True:
            far = end.select(F.col("id").alias("end"), F.col("end").alias("far"))
            ahead = materialise(end.join(far, "end").select("id", "far", (F.col("far") != F.col("end")).alias("moved")), "ends")
            end = ahead.select("id", F.col("far").alias("end"))
            if ahead.where("moved").isEmpty():
                break
        last = end.toDF("label", "end")
        label = end.toDF("id", "label") if label is None else materialise(label.join(last, "label", "left").select("id", F.coalesce("end", "label").alias("label")), "labels")
        drawn = links.join(end.toDF("a", "x"), "a").join(end.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        links = materialise(_ordered(drawn).distinct(), "links")
    return label


def classes(docs: DataFrame, k: int = WORDS, tuples: int = TUPLES, least: float = LEAST) -> DataFrame:
    """One row a row of docs: doc_id, node, class_id (the least doc_id of its class), class_rows, keep (this doc_id and
    text stand for the class)."""
    nodes = numbered_nodes(sketches(docs, k, tuples))
    label = links(nodes, docs, least)
    named = nodes.select("id", "node", "rep", "rows").join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
    first = F.min(F.struct(F.coalesce("rep", F.lit((1 << 63) - 1)).alias("r"), F.col("node").alias("kept"))).alias("k")
    whole = named.groupBy("label").agg(F.min("rep").alias("class_id"), F.sum("rows").alias("class_rows"), first)
    of = materialise(named.select("node", "label").join(whole, "label").select("node", "class_id", "class_rows", (F.col("node") == F.col("k.kept")).alias("kept")), "classes")
    keep = (F.col("kept") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("keep")
    return docs.select("doc_id", node().alias("node")).join(of, "node").select("doc_id", "node", "class_id", "class_rows", keep)


def one_of_each(docs: DataFrame, **params) -> DataFrame:
    """The rows of docs that stand for their class, one of each."""
    keep = classes(docs, **params).where("keep").select(F.col("doc_id").alias("__id"), F.col("node").alias("__n")).distinct()
    mine = docs.withColumn("__n", node())
    same = (mine["__n"] == keep["__n"]) & mine["doc_id"].eqNullSafe(keep["__id"])
    return mine.join(keep, same, "left_semi").dropDuplicates(["doc_id", "__n"]).drop("__n")
