"""Training-order materialisation: token ids in fixed-stride shards, in the order of a keyed permutation.

Texts become sequences of `length` token ids. Sequence number i of all N (in the order of the scan) goes to slot P(i): P
is a keyed Feistel network over the smallest even number of bits that holds N, walked again until it falls below N
(cycle-walking), so it is a permutation that needs no table and that any worker computes for any i. Slots are dealt to
tasks by range, in compressed blocks a shard; each task puts its shards in order one by one, so that it holds one shard
at a time, and writes them whole: slot s lies at (s mod per_shard) * stride.
A reader starts at any slot with one seek.

Token ids are bytes (the vocabulary of byte-level models) unless another tokenizer is given; the ids' type is a
parameter. The tokenizer is called twice for each text, once to count. Shards lie in the shared folder; only those that
the manifest of finished tasks names are read. Record: doc_id (int64), place of the sequence in its text (uint32), number
of tokens (uint32), ids, padded with 0.

The numbering needs the scan to deal rows alike both times; each task checks its number of sequences against the count
and fails the run otherwise. Nulls and empty texts have no sequence; a null doc_id is kept (as the least int64).
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, new_path, partitions

NO_ID = -(1 << 63)
#: Bytes of sequences that a task holds before it sends them off.
BUFFER = 32 << 20
ROUNDS = 6


def feistel(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of sequences i < n: a permutation of range(n)."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key} {r}".encode(), digest_size=8).digest(), "little")) for r in range(ROUNDS)]

    def once(x):
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & low)
        return left << np.uint64(half) | right

    out = once(np.asarray(i, np.uint64))
    while len(far := np.flatnonzero(out >= np.uint64(n))):
        out[far] = once(out[far])
    return out.astype(np.int64)


def bytes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "replace"), np.uint8)


class Order:
    """length: tokens of a sequence; per_shard: records of a shard; dtype: of an id; tokenize: text to array of ids."""

    def __init__(self, length: int = 256, per_shard: int = 32768, key: int = 1, dtype: str = "uint8", tokenize: Callable | None = None):
        self.length, self.per_shard, self.key, self.dtype, self.tokenize = length, per_shard, key, dtype, tokenize or bytes_of
        self.record = np.dtype([("doc_id", "<i8"), ("seq", "<u4"), ("n", "<u4"), ("ids", np.dtype(dtype).newbyteorder("<"), (length,))])


def _counts(docs: DataFrame, order: Order) -> list[tuple[int, int]]:
    """Partition of the scan, sequences in it; one row a partition."""
    if order.tokenize is bytes_of:
        n = F.octet_length(F.coalesce("text", F.lit("")))
        per = docs.select(F.spark_partition_id().alias("p"), F.ceil(n / order.length).cast("long").alias("n"))
    else:
        tokenize, length = order.tokenize, order.length

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                n = sum(-(-len(tokenize(t)) // length) for t in b.column("text").to_pylist() if t)
                yield pa.RecordBatch.from_pydict({"p": pa.array([TaskContext.get().partitionId()], pa.int64()), "n": pa.array([n], pa.int64())})

        per = docs.select("text").mapInArrow(count, "p bigint, n bigint")
    return sorted((int(r.p), int(r.n)) for r in per.groupBy("p").agg(F.sum("n").alias("n")).collect())


def write_shards(docs: DataFrame, folder: str, order: Order) -> tuple[DataFrame, int]:
    """The manifest (path, shard, first_slot, records) and the number of sequences."""
    spark = docs.sparkSession
    counts = _counts(docs, order)
    total, first, own = sum(n for _, n in counts), {}, dict(counts)
    at = 0
    for p, n in counts:
        first[p] = at
        at += n

    shards = max(1, -(-total // order.per_shard))
    tasks = min(shards, max(1, partitions(spark)))
    row = np.dtype([("slot", "<i8"), ("record", order.record)])

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of sequences for one shard each, compressed: far fewer bytes to shuffle than single rows."""
        p = TaskContext.get().partitionId()
        begin = at = first.get(p, 0)
        held, size = [], 0

        def blocks() -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(held)
            shard = rows["slot"] // order.per_shard
            by = np.argsort(shard, kind="stable")
            rows, shard = rows[by], shard[by]
            edges = np.flatnonzero(np.diff(shard)) + 1
            names = shard[np.concatenate([[0], edges])]
            data = [zlib.compress(x.tobytes(), 1) for x in np.split(rows, edges)]
            for o in range(0, len(data), 256):
                yield pa.RecordBatch.from_arrays([pa.array(names[o : o + 256], pa.int64()), pa.array(data[o : o + 256], pa.binary())], names=["shard", "data"])

        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = order.tokenize(text) if text else ()
                n = -(-len(ids) // order.length)
                if not n:
                    continue
                rows = np.zeros(n, row)
                r = rows["record"]
                padded = np.zeros(n * order.length, order.record["ids"].base)
                padded[: len(ids)] = ids
                r["ids"], r["seq"], r["doc_id"], r["n"] = padded.reshape(n, -1), np.arange(n), NO_ID if doc is None else doc, order.length
                r["n"][-1] = len(ids) - (n - 1) * order.length
                rows["slot"] = np.arange(at, at + n)
                at += n
                held.append(rows)
                size += rows.nbytes
                if size >= BUFFER:
                    held = [np.concatenate(held)]
                    held[0]["slot"] = feistel(held[0]["slot"], total, order.key)
                    yield from blocks()
                    held, size = [], 0
        if held:
            held = [np.concatenate(held)]
            held[0]["slot"] = feistel(held[0]["slot"], total, order.key)
            yield from blocks()
        if at - begin != own.get(p, 0):
            raise RuntimeError("the scan dealt its rows otherwise than when they were counted")

    dealt = docs.select("doc_id", "text").mapInArrow(sequences, "shard bigint, data binary")
    ranged = dealt.repartitionById(tasks, F.floor(F.col("shard") * tasks / shards).cast("int")).sortWithinPartitions("shard")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One shard at a time: its blocks, in the order of slots."""
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        now, held = None, []

        def done() -> pa.RecordBatch:
            rows = np.concatenate(held)
            rows = rows[np.argsort(rows["slot"])]
            begin = now * order.per_shard
            if len(rows) != min(order.per_shard, total - begin) or rows["slot"][0] != begin or (np.diff(rows["slot"]) != 1).any():
                raise RuntimeError("slots are not dense")
            name = f"shard-{now:08d}-{uuid.uuid4().hex}.bin"
            with files.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(np.ascontiguousarray(rows["record"]).tobytes())
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "shard": [now], "first_slot": [begin], "records": [len(rows)]})

        for b in batches:
            for shard, data in zip(b.column("shard").to_pylist(), b.column("data").to_pylist(), strict=True):
                if shard != now:
                    if held:
                        yield done()
                    now, held = shard, []
                held.append(np.frombuffer(zlib.decompress(data), row))
        if held:
            yield done()

    return materialise(ranged.mapInArrow(write, "path string, shard bigint, first_slot bigint, records bigint"), "shards"), total


def read_records(path: str, order: Order, start: int = 0, stop: int | None = None, at_once: int = 4096) -> Iterator[np.ndarray]:
    """Records [start, stop) of a shard, read in sequence after one seek."""
    from pyarrow import fs

    files, where = fs.FileSystem.from_uri(path)
    stride = order.record.itemsize
    with files.open_input_file(where) as f:
        end = f.size() // stride if stop is None else stop
        f.seek(start * stride)
        while start < end:
            data = f.read(min(at_once, end - start) * stride)
            if not data or len(data) % stride:
                raise ValueError(f"{path} ends inside a record")
            rows = np.frombuffer(data, order.record)
            start += len(rows)
            yield rows


def read_shards(spark: SparkSession, manifest: DataFrame, order: Order) -> DataFrame:
    """slot, shard, place, doc_id, seq, n_tokens, crc32 of the ids as stored."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, shard, first, records in zip(*[b.column(k).to_pylist() for k in range(4)], strict=True):
                at = 0
                for rows in read_records(path, order):
                    n = len(rows)
                    width = order.record["ids"].base.itemsize
                    crc = [zlib.crc32(r[: k * width]) for r, k in zip((x.tobytes() for x in rows["ids"]), rows["n"].tolist(), strict=True)]
                    ids = [None if x == NO_ID else x for x in rows["doc_id"].tolist()]
                    cols = [np.arange(first + at, first + at + n), np.full(n, shard), np.arange(at, at + n), ids, rows["seq"].astype(np.int64), rows["n"].astype(np.int64), crc]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["slot", "shard", "place", "doc_id", "seq", "n_tokens", "crc32"])
                    at += n
                if at != records:
                    raise ValueError(f"{path} has {at} records in place of {records}")

    return manifest.select("path", "shard", "first_slot", "records").repartition(max(1, partitions(spark))).mapInArrow(read, "slot bigint, shard bigint, place bigint, doc_id bigint, seq bigint, n_tokens bigint, crc32 bigint")


def materialised(docs: DataFrame, order: Order | None = None) -> DataFrame:
    """Writes all sequences of docs to new shards in the shared folder and reads them back."""
    order = order or Order()
    spark = docs.sparkSession
    manifest, _ = write_shards(docs.select("doc_id", "text"), new_path(spark, "order"), order)
    return read_shards(spark, manifest, order)
