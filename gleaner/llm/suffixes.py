"""Suffix-array deduplication: every string of `length` bytes that starts a second time anywhere in the corpus is found,
by longest-previous-factor arrays over suffixes that can match at all.

1. Anchors. Every window of `length` bytes has the `gram`-byte string with the least hash in it as its anchor, leftmost
   first. Equal windows have equal anchors at equal offsets. Windows that follow one another and share an anchor make a
   segment; a segment is some bytes of hash (of its content), its anchor and its place, one for about 180 bytes of text.
   Segments whose anchor is found once in the corpus hold no repeated window.
2. Equal segments. All windows of a segment that occurs twice are repeated.
3. Suffix order. Different segments that share an anchor are brought together (their bytes, read from their first
   occurrence) and their windows are put in suffix order, to the depth of a window, by prefix doubling. The previous and
   next smaller positions in that order give each window's longest previous factor and its source: windows with a factor
   of `length` are later copies, their sources are the earlier ones.
4. Anchors that more than `bound` different segments share (a passage in very many contexts) are never gathered. Their
   windows are dealt into nodes of neighbours by the bytes that all of these have in common; parts that repeat as a whole
   are settled at once, and what is left goes on to narrower nodes, down to single windows. This is as exact as suffix order.

Bytes are compared by 128 bits of hash (anchor and content) where they are not compared themselves. Matches never cross
texts. With keep_first the first occurrence (by doc_id, then text, then place) of every window stays, else all copies go.

Nulls: a null text is empty; a null doc_id comes first. Rows repeated in full (id and text) count as two occurrences of all
their windows if all copies go; with keep_first they are treated alike, as one document. Texts shorter than a window
stay as they are. Further columns are kept, but for earlier ones named as the results. Every row is returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, partitions, row_key
from .words import _powers, mix

LENGTH, GRAM = 400, 32
#: So many different segments of one anchor meet in one task at most (about 2 MB); beyond that, windows are dealt into nodes of these widths.
BOUND, WIDTHS = 4096, (20, 4, 1)
#: Window starts of a text that are worked on at a time, and bytes of segments whose suffixes are sorted at a time.
PIECE, BLOCK = 1 << 18, 1 << 19
_PLACE = np.uint64((1 << 24) - 1)
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)
#: A segment's place as one number: start, windows less one, offset of its anchor.
_BITS = 16


def sliding_least(v: np.ndarray, w: int) -> np.ndarray:
    """Least of every w neighbours."""
    n = len(v) - w + 1
    a = np.concatenate([v, np.full(-len(v) % w, _MOST)]).reshape(-1, w)
    left = np.minimum.accumulate(a, axis=1).ravel()
    right = np.minimum.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Owners, offsets and bytes of texts, or of overlapping parts of long ones, about PIECE bytes at a time."""
    owner, base, part, held = [], [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, len(t) - length + 1, PIECE):
            own = t[at : at + PIECE + length - 1]
            owner.append(i)
            base.append(at)
            part.append(own)
            held += len(own)
            if held >= PIECE:
                yield owner, base, part
                owner, base, part, held = [], [], [], 0
    if part:
        yield owner, base, part


def segments(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """owner, start, size (bytes), offset of the anchor, hash of the anchor, hash of the content."""
    for owner, base, part in _pieces(texts, length):
        whole = b"".join(part)
        data = np.frombuffer(whole, np.uint8)
        sizes = np.array([len(p) for p in part])
        ends = np.cumsum(sizes)
        hashes = gram_hashes(data, gram)
        least = sliding_least((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)
        place = (least & _PLACE).astype(np.int64)
        inside = np.zeros(len(data) + 1, np.int8)
        np.add.at(inside, ends - sizes, 1)
        np.add.at(inside, ends - length + 1, -1)
        inside = np.cumsum(inside[: len(place)]).astype(bool)
        new = inside.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
        last = inside.copy()
        last[:-1] &= (place[1:] != place[:-1]) | ~inside[1:] | new[1:]
        starts, lasts = np.flatnonzero(new), np.flatnonzero(last)
        own = np.searchsorted(ends, starts, "right")
        anchor = place[starts]
        view = memoryview(whole)
        rows = zip(own.tolist(), starts.tolist(), lasts.tolist(), anchor.tolist(), (starts - (ends - sizes)[own]).tolist(), hashes[anchor].view(np.int64).tolist(), strict=True)
        for o, s, e, p, at, h in rows:
            content = hashlib.blake2b(view[s : e + length], digest_size=8).digest()
            yield owner[o], base[o] + at, e + length - s, p - s, h, int.from_bytes(content, "little", signed=True)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every string of that many bytes."""
    up, down = _powers(len(data) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[: len(data)])])
    return mix((total[size:] - total[:-size]) * up[size : len(data) + 1])


def _pos(start: int, size: int, off: int, length: int) -> int:
    return start << (2 * _BITS) | (size - length) << _BITS | off


def _unpacked(pos: int, length: int) -> tuple[int, int, int]:
    return pos >> (2 * _BITS), (pos >> _BITS & 0xFFFF) + length, pos & 0xFFFF


def window_ranks(data: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Rank of the window that starts at each place, by its bytes; -1 where the segment ends before. ends: of the segment
    that each place is in. Prefix doubling: ranks of twice the depth are those of pairs."""
    n, depth = len(data), 8
    padded = np.concatenate([data, np.zeros(depth, np.uint8)])
    at = np.flatnonzero(np.arange(n) + depth <= ends)
    rank = np.full(n, -1, np.int64)
    rank[at] = np.unique(np.ndarray((n,), ">u8", padded.tobytes(), 0, (1,)).astype(np.uint64)[at], return_inverse=True)[1]
    while depth < length:
        step = min(depth, length - depth)
        at = np.flatnonzero(np.arange(n) + depth + step <= ends)
        pairs = rank[at] * np.int64(n + 1) + rank[at + step]
        rank = np.full(n, -1, np.int64)
        rank[at] = np.unique(pairs, return_inverse=True)[1]
        depth += step
    return rank


def previous_factors(order: list[int], lcp: list[int]) -> tuple[list[int], list[int]]:
    """Longest previous factor of every position in suffix order, and where it starts (-1: none): the greater of what it has
    in common with the previous and with the next smaller position. lcp: of each with the one before it in the order."""
    factor, source, stack = [0] * len(order), [-1] * len(order), []
    for i, (p, common) in enumerate(zip([*order, -1], [*lcp, 0], strict=True)):
        while stack and p < stack[-1][0]:
            _, before, k = stack.pop()
            if before or common:
                factor[k], source[k] = (before, stack[-1][0]) if before >= common else (common, p)
            common = min(before, common)
        stack.append((p, common if stack else 0, i))
    return factor, source


def repeated_windows(parts: list[bytes], length: int, keep_first: bool) -> list[np.ndarray]:
    """For each segment, whether each of its windows is a copy (keep_first: of one in the same or an earlier segment).
    Windows whose hash is found once here have no copy, so that only the stretches between others are sorted."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    begin = np.cumsum(sizes) - sizes
    whole = np.arange(len(data)) + length <= np.repeat(begin + sizes, sizes)
    at = np.flatnonzero(whole)
    ranked, times = np.unique(gram_hashes(data, length)[at], return_inverse=True, return_counts=True)[1:]
    at = at[times[ranked] > 1]
    hit = np.zeros(len(data), bool)
    if len(at):
        owner = np.searchsorted(begin, at, "right") - 1
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (at[1:] - at[:-1] > length)])
        first, last = at[new], at[np.concatenate([new[1:], [True]])]
        some = np.concatenate([np.arange(a, e + length) for a, e in zip(first.tolist(), last.tolist(), strict=True)])
        spans = last + length - first
        rank = window_ranks(data[some], np.repeat(np.cumsum(spans), spans), length)
        places = np.flatnonzero(rank >= 0)
        order = places[np.argsort(rank[places], kind="stable")]
        same = np.concatenate([[False], rank[order][1:] == rank[order][:-1]])
        member = same | np.concatenate([same[1:], [False]])  # others have no factor of that length
        factor, source = previous_factors(order[member].tolist(), np.where(same[member], length, 0).tolist())
        later = np.array(factor, np.int64) >= length
        hit[some[order[member][later]]] = True
        if not keep_first:
            hit[some[np.array(source, np.int64)[later]]] = True
    return [hit[b : b + n - length + 1] for b, n in zip(begin.tolist(), sizes.tolist(), strict=True)]


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of every run."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


def _slices(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches with about so many bytes of text, and these texts: what Python holds is many times the text."""
    for b in batches:
        text = b.column("text").cast(pa.binary())
        total = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < len(b):
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + size, "right")))
            yield b.slice(i, j - i), [t or b"" for t in text.slice(i, j - i).to_pylist()]
            i = j


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_SPANS = pa.schema([("key", pa.binary()), ("start", pa.int64()), ("end", pa.int64())])
SPANS = "key binary, start bigint, end bigint"


def _key() -> Column:
    """16 bytes, never null: joins on it need no filter, and so all of them find the same exchange of texts."""
    return F.coalesce(F.unhex(row_key()), F.lit(b"")).alias("key")


def found_segments(base: DataFrame, length: int, gram: int) -> DataFrame:
    """key, doc_id, s (pos, anchor, content): one row a row of docs with a window, written once."""
    schema = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("s", pa.list_(pa.struct([("pos", pa.int64()), ("anchor", pa.int64()), ("content", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in _slices(batches):
            owner, pos, anchor, content = [], [], [], []
            for o, start, size, off, h, c in segments(texts, length, gram):
                owner.append(o)
                pos.append(_pos(start, size, off, length))
                anchor.append(h)
                content.append(c)
            some, count = np.unique(np.array(owner, np.int64), return_counts=True)
            values = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (pos, anchor, content)], ["pos", "anchor", "content"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), values)
            picked = b.select(["key", "doc_id"]).take(pa.array(some))
            yield pa.RecordBatch.from_arrays([picked.column(0), picked.column(1), lists], schema=schema)

    return materialise(base.mapInArrow(run, "key binary, doc_id bigint, s array<struct<pos:bigint,anchor:bigint,content:bigint>>"), "segments")


def _later(rows: DataFrame, keep_first: bool) -> DataFrame:
    """rows without those that are the first of their kind, if these stay."""
    return rows.where(~F.struct("doc_id", "key", "pos").eqNullSafe(F.col("first"))) if keep_first else rows


def _place(length: int, pos: str = "pos") -> tuple[Column, Column]:
    """start and size of a segment."""
    return F.shiftright(pos, 2 * _BITS), F.shiftright(pos, _BITS).bitwiseAND(F.lit(0xFFFF)) + length


def repeated_spans(base: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_first: bool = True, bound: int = BOUND, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """key (of a row's id and text), start, end: byte spans of copies; they overlap. base: key, doc_id, text; a caller that
    joins just these by key shares the exchange of texts."""
    c = F.col
    found = found_segments(base, length, gram)
    anchors = found.select(F.explode("s.anchor").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("n"))
    often = materialise(anchors.where("n > 1").select("anchor"), "anchors")  # written, so that the join can split a hot anchor
    each = found.select("key", "doc_id", F.explode("s").alias("s")).select("key", "doc_id", "s.*")
    likely = materialise(each.join(often, "anchor"), "likely")
    first = F.min(F.struct("doc_id", "key", "pos")).alias("first")
    different = materialise(likely.groupBy("anchor", "content").agg(F.count("*").alias("n"), first), "contents")

    start, size = _place(length)
    copies = _later(likely.join(different.where("n > 1").select("anchor", "content", *["first"] * keep_first), ["anchor", "content"]), keep_first)
    whole = copies.select("key", start.alias("start"), (start + size).alias("end"))

    shared = different.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1")
    meet = different.join(shared, "anchor").select("anchor", "n", "m", "first.*")
    few, many = (with_bytes(base, meet.where(x), length) for x in (c("m") <= bound, c("m") > bound))
    return whole.union(suffix_sorted(few, length, keep_first)).union(split_windows(many, length, gram, keep_first, widths))


def with_bytes(base: DataFrame, meet: DataFrame, length: int) -> DataFrame:
    """anchor, n, doc_id, key, pos, bytes: each segment of meet with its bytes, read from its row. Not written down: what
    needs it again reads the exchange of texts again."""
    schema = pa.schema([("anchor", pa.int64()), ("n", pa.int64()), ("doc_id", pa.int64()), ("key", pa.binary()), ("pos", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in _slices(batches):
            mine = b.column("mine")
            count = pa.compute.list_value_length(mine).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(b)), count)
            flat = mine.flatten()
            anchor, n, pos = (flat.field(i) for i in range(3))
            cut = [texts[o][x >> (2 * _BITS) : (x >> (2 * _BITS)) + (x >> _BITS & 0xFFFF) + length] for o, x in zip(owner.tolist(), pos.to_pylist(), strict=True)]
            own = b.select(["doc_id", "key"]).take(pa.array(owner))
            yield pa.RecordBatch.from_arrays([anchor, n, own.column(0), own.column(1), pos, pa.array(cut, pa.binary())], schema=schema)

    of = meet.groupBy("key").agg(F.collect_list(F.struct("anchor", "n", "pos")).alias("mine"))  # the segments of one text
    return base.join(of, "key").select("key", "doc_id", "text", "mine").mapInArrow(run, "anchor bigint, n bigint, doc_id bigint, key binary, pos bigint, bytes binary")


def suffix_sorted(parts: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """key, start, end: from suffix order within anchors. Anchors are small; many are sorted together."""

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        out = []
        for (_, n, key, pos, _), hit in zip(rows, repeated_windows([r[4] for r in rows], length, keep_first), strict=True):
            if n == 1 or keep_first:  # else all its windows are known
                start = _unpacked(pos, length)[0]
                out += [(key, start + a, start + e + length) for a, e in _runs(hit)]
        return _batch(out, _SPANS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches:
            for row in zip(*[b.column(k).to_pylist() for k in ("anchor", "n", "key", "pos", "bytes")], strict=True):
                if rows and row[0] != rows[-1][0] and held >= BLOCK:
                    yield settle(rows)
                    rows, held = [], 0
                if not rows or (row[0], row[2], row[3]) != (rows[-1][0], rows[-1][2], rows[-1][3]):  # rows repeated in full come twice
                    rows.append(row)
                    held += len(row[4])
        if rows:
            yield settle(rows)

    spark = parts.sparkSession
    dealt = parts.select("anchor", "n", "doc_id", "key", "pos", "bytes").repartition(partitions(spark), "anchor").sortWithinPartitions("anchor", "doc_id", "key", "pos")
    return dealt.select("anchor", "n", "key", "pos", "bytes").mapInArrow(run, SPANS)


def _digest(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=16).digest()


def split_windows(parts: DataFrame, length: int, gram: int, keep_first: bool, widths: tuple[int, ...]) -> DataFrame:
    """key, start, end: for anchors of many segments. A window that begins a bytes before its anchor is in node a // width.
    All windows of a node have some bytes in common, which name its block. Where a segment's part of a block repeats as a
    whole, it is settled; where a block has different parts, these go on to narrower nodes, the last of single windows."""
    c = F.col
    schema = pa.schema([("block", pa.binary()), ("content", pa.binary()), ("n", pa.int64()), ("doc_id", pa.int64()), ("key", pa.binary()), ("pos", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])

    def dealing(width: int):
        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = []
                for n, doc_id, key, pos, low, high, data in zip(*[b.column(k).to_pylist() for k in ("n", "doc_id", "key", "pos", "lo", "hi", "bytes")], strict=True):
                    off = pos & 0xFFFF
                    for first in range(low // width * width, high + 1, width):
                        last = min(first + width, length - gram + 1) - 1
                        lo, hi = max(low, first), min(high, last)
                        block = _digest(b"%d " % first, data[off - first : off + length - last])  # what all windows of the node hold
                        rows.append((block, _digest(b"%d %d %d " % (first, lo, hi), data[off - hi : off - lo + length]), n, doc_id, key, pos, lo, hi))
                yield _batch(rows, schema)

        return deal

    begin, size = _place(length)
    off = c("pos").bitwiseAND(F.lit(0xFFFF))
    texts = parts.select("key", "pos", "bytes").dropDuplicates(["key", "pos"])
    rest = parts.withColumn("lo", off - size + length).withColumn("hi", off)
    # Rows repeated in full come twice here, once a place.
    place = F.struct("doc_id", "key", "pos")
    first, last = F.min(place).alias("first"), F.max(place).alias("last")
    out = None
    for width in widths:
        dealt = rest.select("n", "doc_id", "key", "pos", c("lo").cast("int").alias("lo"), c("hi").cast("int").alias("hi"), "bytes").mapInArrow(dealing(width), "block binary, content binary, n bigint, doc_id bigint, key binary, pos bigint, lo int, hi int")
        contents = dealt.groupBy("block", "content").agg(F.max("n").alias("n"), first, last)
        copied = contents.where("n > 1 or first != last").select("block", "content", "first")
        again = _later(dealt.join(copied, ["block", "content"]), keep_first)
        spans = again.select("key", (begin + off - c("hi")).alias("start"), (begin + off - c("lo") + length).alias("end"))
        out = spans if out is None else out.union(spans)
        mixed = contents.groupBy("block").agg(F.count("*").alias("m")).where("m > 1").select("block")
        rest = dealt.join(mixed, "block").select("key", "pos", "n", "doc_id", "lo", "hi").join(texts, ["key", "pos"])
    return out


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_first: bool = True, bound: int = BOUND, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """The rows of docs with n_bytes, n_removed, n_spans (maximal removed runs) and kept (binary: what is left)."""
    if length < max(8, gram + 1) or length > 1 << 15 or widths[-1] != 1:
        raise ValueError("a window has more bytes than a gram, 8 at least and 32768 at most; the last nodes are single windows")
    made = ["n_bytes", "n_removed", "n_spans", "kept"]
    docs = docs.drop(*made)
    base = docs.select(_key(), F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = repeated_spans(base, length, gram, keep_first, bound, widths)
    of = spans.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # those of one text
    more = [x for x in docs.columns if x not in ("doc_id", "text")]
    whole = docs.select(_key(), "doc_id", "text", F.struct(*more).alias("rest")) if more else base
    mine = whole.join(of, "key", "left").drop("key")
    schema = T.StructType([*whole.schema.fields[1:], *[T.StructField(k, T.LongType()) for k in made[:3]], T.StructField("kept", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in _slices(batches):
            sizes, gone, count, kept = [], [], [], []
            for text, spans in zip(texts, b.column("spans").to_pylist(), strict=True):
                left, at, n = [], 0, 0
                for start, end in sorted((x["start"], x["end"]) for x in spans or ()):
                    if start > at or not n:
                        left.append(text[at:start])
                        n += 1
                    at = max(at, end)
                left.append(text[at:])
                kept.append(b"".join(left))
                sizes.append(len(text))
                gone.append(len(text) - len(kept[-1]))
                count.append(n)
            own = b.drop_columns(["spans"])
            yield pa.RecordBatch.from_arrays([*own.columns, *[pa.array(x, pa.int64()) for x in (sizes, gone, count)], pa.array(kept, pa.binary())], names=[*own.schema.names, *made])

    out = mine.mapInArrow(run, schema)
    return out.select(*[F.col("rest")[k].alias(k) if k in more else k for k in docs.columns], *made)


def removed_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: all copies of repeated 400-byte strings go."""
    left = without_repeats(docs.select("doc_id", "text"), keep_first=False)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n_bytes
  FROM documents),
b AS (SELECT row, base, n_bytes, substr(h, 2 * base::INTEGER + 1, 2798) AS h FROM (SELECT row, h, n_bytes, unnest(range(0, n_bytes - 399, 1000)) AS base FROM d WHERE n_bytes >= 400)),
w AS (SELECT row, base + p AS p, hash(substr(h, 2 * p::INTEGER - 1, 800)) AS k FROM (SELECT row, h, base, unnest(range(1, least(1001, n_bytes - base - 398))) AS p FROM b)),
t AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
m AS (SELECT row, p FROM w SEMI JOIN t ON w.k = t.k),
e AS (SELECT row, p, coalesce(p - lag(p) OVER (PARTITION BY row ORDER BY p) > 400, true) AS new FROM m),
g AS (SELECT row, p, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY row ORDER BY p) AS span FROM e),
s AS (SELECT row, span, min(p) AS a, max(p) + 400 AS z FROM g GROUP BY row, span),
c AS (SELECT row, a, z, coalesce(lag(z) OVER (PARTITION BY row ORDER BY a), 1) AS left_from FROM s),
r AS (SELECT row, count(*) AS n_spans, sum(z - a)::BIGINT AS n_removed, max(z) AS last, list([left_from, a] ORDER BY a) AS kept FROM c GROUP BY row)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE
         array_to_string(list_transform(kept, lambda k: substr(h, 2 * k[1]::INTEGER - 1, 2 * (k[2] - k[1])::INTEGER)), '') || substr(h, 2 * last::INTEGER - 1) END)) AS kept_sha256
FROM d LEFT JOIN r ON d.row = r.row
"""
