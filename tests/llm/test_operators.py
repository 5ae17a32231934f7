"""The ten operators and the pipeline on small cases: odd rows, brute force, round trips, held-out accuracy."""

import hashlib
import io
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleaner.llm import chat, fingerprints, linededup, media, mixing, neardup, order, packing, toxicity, warc
from gleaner.llm.common import materialise

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in "ba be bi bo bu da de di do du ka ke ki ko ku".split() for b in "lan rin tos mur pel".split()]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd(spark, extra=""):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns."""
    rng = random.Random(3)
    long = "\n".join(prose(rng, 40) for _ in range(400))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "no id " + prose(rng, 30), "en", "a", 1), (4, long, "de", "b", 9), (5, long, "de", "b", 9), (6, "x", "fr", "a", 1), (6, "x", "fr", "a", 1), (6, "y other", "fr", "a", 1), (7, "   \n ", "en", None, 5), (8, "é" * 300, "xx", "a", 300)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("key", "idx", "rate", "node", "score", "payload", "n_lines", "mix_key", "spans", "digest", "l"):
        df = df.withColumn(name, F.lit("mine"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- 1 ---


def test_media_round_trip_and_odd_rows(spark):
    rows = media.document_media(odd(spark)).collect()
    assert len(rows) == 10 and media.document_media(empty(spark)).count() == 0
    texts = {(r.doc_id, r.text) for r in odd(spark).collect()}
    want = set()
    for i, t in texts:
        raw = (t or "").encode()
        p = raw + b" " * (192 if not raw else -len(raw) % 192)
        want.add((i, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])))
    assert {(r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows} == want
    assert len({r.feature for r in rows if r.doc_id in (4, 5)}) == 1


def test_interleaving_keeps_order_positions_and_captions():
    seq = media.parse_html("<p>One <b>two</b></p><figure><img src='sha256:aa' alt='alt'><figcaption>The <i>cap</i></figcaption></figure>mid<img src='x.png' alt='only alt'><script>no</script><p>end")
    assert [(x["position"], x["kind"], x["text"], x["digest"], x["caption"]) for x in seq] == [(0, "text", "One two", None, None), (1, "media", None, "aa", "The cap"), (2, "text", "mid", None, None), (3, "media", None, hashlib.sha256(b"x.png").hexdigest(), "only alt"), (4, "text", "end", None, None)]
    assert media.parse_html(None) == [] and media.parse_html("<figcaption>x</figcaption></figure><p>") != None  # noqa: E711


@pytest.mark.parametrize(
    "page, want",
    [
        ("<figure><figcaption>cap</figcaption><img src='sha256:a'></figure>after", [("media", None, "cap"), ("text", "after", None)]),
        ("<figure><img src='sha256:a'><figcaption>cap</figure><p>the rest</p>end", [("media", None, "cap"), ("text", "the rest", None), ("text", "end", None)]),
        ("<figure><img src='sha256:a'><figcaption>cap", [("media", None, "cap")]),
        ("<div>a<template>no</div><p>the rest", [("text", "a", None), ("text", "the rest", None)]),
        ("<noscript><img src='sha256:a'>no</noscript>yes", [("text", "yes", None)]),
        ("<figure><figcaption>alone</figcaption></figure><p>x", [("text", "alone", None), ("text", "x", None)]),
        ("<figure><figure><img src='sha256:a' alt='x'></figure><figcaption>c</figcaption><img src='sha256:b'></figure>", [("media", None, "x"), ("media", None, "c")]),
    ],
)
def test_html_that_is_out_of_order(page, want):
    got = media.parse_html(page)
    assert [(x["kind"], x["text"], x["caption"]) for x in got] == want
    assert [x["position"] for x in got] == list(range(len(got)))


def test_resolve_keeps_missing_payloads(spark):
    df = spark.createDataFrame([(1, "a<img src='sha256:k1'>b<img src='sha256:k2'>")], "id int, html string").select("id", media.sequences(F.col("html")).alias("sequence"))
    store = spark.createDataFrame([("k1", b"1"), ("k1", b"1"), (None, b"2")], "digest string, payload binary")
    got = sorted(media.resolve(df, store).collect(), key=lambda r: r.position)
    assert [(r.kind, r.text, None if r.payload is None else bytes(r.payload)) for r in got] == [("text", "a", None), ("media", None, b"1"), ("text", "b", None), ("media", None, None)]
    with pytest.raises(ValueError):
        media.from_ppm(b"P6\n64 2\n255\n" + b" " * 192)


# --- 2 ---


def test_feistel_is_a_keyed_permutation():
    for n in (1, 2, 3, 17, 1000, 4097):
        assert sorted(order.feistel(np.arange(n), n, 5).tolist()) == list(range(n))
    assert order.feistel(np.arange(1000), 1000, 5).tolist() != order.feistel(np.arange(1000), 1000, 6).tolist()


def test_training_order_round_trip_and_resume(spark, tmp_path):
    o = order.Order(length=16, per_shard=100)
    docs = odd(spark)
    manifest, total = order.write_shards(docs.select("doc_id", "text"), f"file://{tmp_path}", o)
    files = sorted(manifest.collect(), key=lambda r: r.shard)
    rows = np.concatenate([x for f in files for x in order.read_records(f.path, o)])
    assert len(rows) == total == sum(f.records for f in files)
    back = {}
    for r in rows:
        back.setdefault(int(r["doc_id"]), {}).setdefault(int(r["seq"]), set()).add(bytes(r["ids"][: r["n"]]))
    text = next(r.text for r in docs.collect() if r.doc_id == 4)
    assert b"".join(next(iter(back[4][k])) for k in sorted(back[4])) == text.encode()
    assert order.NO_ID in back and 1 not in back and 2 not in back
    tail = np.concatenate(list(order.read_records(files[0].path, o, start=37)))
    assert (tail == np.concatenate(list(order.read_records(files[0].path, o)))[37:]).all()
    assert order.materialised(empty(spark)).count() == 0
    two = order.Order(length=4, per_shard=64, dtype="uint16", tokenize=lambda t: np.arange(len(t)) + 500)
    assert order.materialised(docs, two).agg(F.sum("n_tokens")).first()[0] == sum(len(r.text or "") for r in docs.collect())


def test_training_order_slot_by_slot(spark, tmp_path):
    """Slot P(i) holds sequence i, numbered in the order of the scan."""
    rng = random.Random(13)
    docs = spark.createDataFrame([(i, prose(rng, rng.randint(0, 40)), "en", "s", 1) for i in range(50)], SCHEMA).coalesce(1)
    o = order.Order(length=16, per_shard=64, key=9)
    manifest, total = order.write_shards(docs.select("doc_id", "text"), f"file://{tmp_path}", o)
    rows = np.concatenate([x for f in sorted(manifest.collect(), key=lambda r: r.shard) for x in order.read_records(f.path, o)])
    want = [(r.doc_id, k) for r in docs.collect() for k in range(-(-len(r.text.encode()) // 16))]
    slots = order.feistel(np.arange(total), total, 9)
    assert len(want) == total and [(int(rows[s]["doc_id"]), int(rows[s]["seq"])) for s in slots] == want


# --- 3 ---


def test_warc_round_trip_and_revisits(spark):
    pages = spark.createDataFrame([(3, "http://a/ b", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "u", None), (9, "u", ""), (None, "u", "z"), (4, "u", "<p>é</p>"), (4, "u", "<p>é</p>")], "page_id long, url string, html string").withColumn("digest", F.lit("mine"))
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archived_pages(pages).collect()), key=str)
    d = lambda x: warc.sha1(x.encode())
    e = d("<p>é</p>")
    assert got == sorted([(3, 9, e, "revisit", 1), (1, 9, e, "response", None), (2, 0, d(""), "response", None), (9, 0, d(""), "revisit", 2), (None, 1, d("z"), "response", None), (4, 9, e, "revisit", 1), (4, 9, e, "revisit", 1)], key=str)
    assert warc.archived_pages(pages.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_warc_reader_frames_and_verifies(chunk):
    one, two = warc.record(1, "u", b"x" * 5000), warc.record(2, "u", b"", 1, True)
    got = [warc.parse(m) for m in warc.members(io.BytesIO(one + two), chunk)]
    assert [(g["fields"]["warc-type"], g["payload_bytes"], len(g["payload"])) for g in got] == [("response", 5000, 5000), ("revisit", 0, 0)]
    with pytest.raises(ValueError, match="inside"):
        list(warc.members(io.BytesIO(one[:-9])))
    plain = next(warc.members(io.BytesIO(one)))
    for wrong in (plain.replace(b"xxxx", b"xxxy", 1), plain[:-5] + plain[-4:], plain + b"!"):
        with pytest.raises(ValueError):
            warc.parse(wrong)


def test_warc_reader_takes_foreign_records():
    """Records of other kinds, without an HTTP head, digests or a length in it."""
    import gzip

    def foreign(kind, block, *fields):
        head = "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", *fields, f"Content-Length: {len(block)}"])
        return gzip.compress(head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n")

    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n0\r\n\r\n"
    http = "Content-Type: application/http; msgtype=response"
    data = foreign("warcinfo", b"software: x\r\n") + foreign("request", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http; msgtype=request") + foreign("response", chunked, http)
    got = [warc.parse(m) for m in warc.members(io.BytesIO(data * 300))]
    assert len(got) == 900
    assert [(g["fields"]["warc-type"], g["payload"]) for g in got[:3]] == [("warcinfo", b"software: x\r\n"), ("request", b""), ("response", b"3\r\nabc\r\n0\r\n\r\n")]
    long = warc.record(1, "u", random.Random(1).randbytes(3 << 20))
    assert [warc.parse(m)["payload_bytes"] for m in warc.members(io.BytesIO(long * 2))] == [3 << 20] * 2


# --- 4 ---


def test_poisson_mix_rates_and_draws(spark):
    rows = [(i, "w" * (10 if i % 4 else 30), "en", "big" if i % 10 else "small", 1) for i in range(4000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = poisson = mixing.poisson_mix(docs, {"big": 1.0, "small": 1.0}).toPandas()
    size = poisson.text.str.len().groupby(poisson.source).sum()
    assert abs(size["big"] / size.sum() - 0.5) < 0.04
    assert out.mix_key.is_monotonic_increasing and not out.duplicated(["doc_id", "mix_copy"]).any()
    counts = out[out.source == "big"].groupby("doc_id").size()
    rate = out[out.source == "big"].mix_rate.iloc[0]
    assert abs(1 - len(counts) / 3600 - np.exp(-rate)) < 0.03  # the share of documents without a copy
    big = mixing.poisson_mix(spark.createDataFrame([(i, "ab", "en", "s" if i else "t" * 1, 1) for i in range(2)], SCHEMA), {"s": 0.001, "t": 0.999}).groupBy("source").count().collect()
    assert big
    hot = mixing.poisson_mix(spark.createDataFrame([(0, "a", "en", "s", 1), (1, "a" * 99999, "en", "t", 1)], SCHEMA), {"s": 0.01, "t": 0.99}).where("source = 's'").count()
    assert abs(hot - 1000) < 160  # a mean far above one draw's


def test_poisson_mix_odd_rows(spark):
    out = mixing.poisson_mix(odd(spark)).collect()
    assert {"key", "rate", "mix_key"} <= set(out[0].asDict()) and all(r.rate == "mine" for r in out)
    same = [r for r in out if r.doc_id == 6 and r.text == "x"]
    assert len(same) % 2 == 0
    assert mixing.poisson_mix(empty(spark)).count() == 0


# --- 5 ---


def test_fingerprint_counts_occurrences_and_order(spark):
    rng = random.Random(1)
    a = prose(rng, 300)
    w = a.split(" ")
    texts = [a, a, " ".join(w[150:] + w[:150]), " ".join(w[:280] + ["new"] * 20), prose(rng, 300), "ab " * 400, "ab " * 1200, "", None, "z"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("fp", fingerprints.order_minhash(F.col("text")))
    fp = {r.i: r.fp for r in df.collect()}
    assert fp[0] == fp[1] and fp[7] == fp[8] and fp[5] != fp[6]
    like = {(r.i, r.j): r.l for r in df.alias("a").crossJoin(df.select(F.col("i").alias("j"), F.col("fp").alias("fq"))).select("i", "j", fingerprints.likeness(F.col("fp"), F.col("fq")).alias("l")).collect()}
    assert like[0, 1] == 1.0 and like[0, 4] == 0.0 and like[0, 3] > 0.5
    assert like[0, 2] < like[0, 3]  # moved halves have the same words but another order
    # against brute force: the packed hashes of the repeats
    s = spark.createDataFrame([("ab cd ef " * 200,)], "text string").select(fingerprints.kmers(F.split("text", " "), 3).alias("s")).first().s
    many = spark.createDataFrame([(s,)], "s array<bigint>").select(fingerprints.labelled_repeats(F.col("s")).alias("r")).first().r
    firsts = {x >> fingerprints.POS for x in s}
    assert len(many) == len(s) - len(firsts) and len({x >> fingerprints.POS for x in many}) == len(many)


def test_fingerprint_selects_the_least_of_each_bin(spark):
    text = prose(random.Random(5), 500)
    df = spark.createDataFrame([(text,)], "text string")
    s = df.select(fingerprints.kmers(F.split("text", " "), 3).alias("s")).first().s
    again = spark.createDataFrame([(s,)], "s array<bigint>").select(fingerprints.labelled_repeats(F.col("s")).alias("r")).first().r
    firsts, seen = [], set()
    for x in s:
        if x >> fingerprints.POS not in seen:
            firsts.append(x)
        seen.add(x >> fingerprints.POS)
    bins = {}
    for x in sorted(firsts + list(again)):
        bins.setdefault((x >> 59) & 31, []).append(x)
    got = df.select(fingerprints.order_minhash(F.col("text")).alias("fp")).first().fp
    mask = (1 << fingerprints.POS) - 1
    pairs = [(b, sorted(v[:2], key=lambda x: x & mask)) for b, v in sorted(bins.items())]
    rows = spark.createDataFrame([(b, v[0] >> fingerprints.POS, v[1] >> fingerprints.POS if len(v) > 1 else None) for b, v in pairs], "b long, x long, y long")
    h = F.when(F.col("y").isNull(), F.xxhash64("x")).otherwise(F.xxhash64("x", "y"))
    want = [r.e for r in rows.orderBy("b").select(F.shiftleft("b", 32).bitwiseOR(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("e")).collect()]
    assert list(got) == want


def test_likeness_is_continuous_in_length(spark):
    rng = random.Random(4)
    a = prose(rng, 60)[:260]
    cjk = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(400))
    lines = [rng.choice(WORDS) for _ in range(300)]
    pairs = [(a, a[:250]), (cjk, cjk[:200] + "x" + cjk[201:]), ("\n".join(lines), "\n".join(lines[:150] + ["x"] + lines[151:]))]
    df = spark.createDataFrame(pairs, "a string, b string")
    like = [r.l for r in df.select(fingerprints.likeness(fingerprints.order_minhash(F.col("a")), fingerprints.order_minhash(F.col("b"))).alias("l")).collect()]
    assert min(like) > 0.6
    docs = spark.createDataFrame([(1, prose(rng, 60)[:320], "en", "s", 1), (2, "short", "en", "s", 1)], SCHEMA)
    assert next(r.near_edited for r in fingerprints.edited_and_next(docs).collect() if r.doc_id == 1) > 0.4


def test_edited_texts_against_brute_force(spark):
    docs = odd(spark)
    got = {r.doc_id: r for r in fingerprints.edited_and_next(docs).collect()}
    by = {}
    for r in docs.collect():
        by.setdefault(r.doc_id, []).append(r.text or "")
    ids = sorted(by, key=lambda x: (x is not None, x or 0))
    one = {i: min(by[i]) for i in ids}
    assert set(got) == set(ids)
    for i, j in zip(ids, ids[1:] + ids[:1], strict=True):
        t, q = one[i], len(one[i]) // 4
        edited = t[: len(t) - q] + one[j][:q]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[4].fingerprint == got[5].fingerprint and got[4].near_next == 1.0
    assert fingerprints.edited_and_next(empty(spark)).count() == 0


# --- 6 ---


def test_line_chunks_remove_later_passages_only(spark):
    rng = random.Random(7)
    passages = ["\n".join(prose(rng, n) for n in (12, 51, 9, 30)), prose(rng, 70)]
    rows = []
    for i in range(60):
        own = [prose(rng, rng.randint(5, 30)) for _ in range(8)]
        own.insert(rng.randint(0, 8), passages[i % 2])
        rows.append((i, "\n".join(own), "en", "s", 1))
    docs = spark.createDataFrame(rows, SCHEMA)
    out = {r.doc_id: r for r in linededup.without_repeats(docs).collect()}
    for k, p in enumerate(passages):
        assert p in out[k].text
        assert sum(p in r.text for r in out.values()) == 1
        long = max(p.split("\n"), key=len)
        assert sum(long in r.text for r in out.values()) <= 4
    for i, t, *_ in rows:  # own lines stay, in order
        left = out[i].text.split("\n")
        assert [x for x in t.split("\n") if x in left] == left
        assert out[i].n_removed == out[i].n_lines - len(left)
    every = {x for _, t, *_ in rows for x in t.split("\n")}
    assert every == {x for r in out.values() for x in r.text.split("\n")}


def test_line_chunks_find_passages_of_short_lines(spark):
    """Passages of any lines go whole, wherever they stand; lines of their own stay."""
    rng = random.Random(17)
    rows, shared = [], {}
    for g in range(60):
        n, words = ((3, 19), (4, 13), (5, 11), (10, 6), (1, 60), (2, 5))[g % 6]
        passage = [prose(rng, words) for _ in range(n)]
        for c in range(2):
            own = [prose(rng, rng.randint(6, 18)) for _ in range(6)]
            at = rng.randint(0, 6)
            rows.append((2 * g + c, "\n".join(own[:at] + passage + own[at:]), "en", "s", 1))
            shared[2 * g + c] = "\n".join(own if c else own[:at] + passage + own[at:])
    out = linededup.without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.text for r in out} == shared


def test_line_chunks_odd_rows(spark):
    docs = odd(spark)
    out = linededup.without_repeats(docs).collect()
    assert len(out) == 10 and all(r.key == "mine" and r.l == "mine" for r in out)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].text is None and by[1][0].n_removed == 0 and by[2][0].text == ""
    assert by[4][0].n_removed == 0 and by[5][0].n_removed == 400 and by[5][0].text == ""
    assert sorted(r.text for r in by[6]) == ["x", "x", "y other"]
    assert linededup.without_repeats(empty(spark)).count() == 0


# --- 7 ---


def test_boundaries_are_optimal():
    rng = random.Random(2)
    for _ in range(200):
        ends = sorted(rng.sample(range(60), rng.randint(1, 9)))
        h = [(e, r := rng.randint(1, 9), sum(rng.randint(max(0, e - 2), e) for _ in range(r))) for e in ends]
        cost = lambda cut: sum(next(x for x in cut if x >= e) * r - t for e, r, t in h)
        for k in (1, 2, 3, 5):
            got = packing.boundaries(h, k)
            assert len(got) <= k and cost(got) == min(cost(sorted({*c, ends[-1]})) for n in range(k) for c in combinations(ends, n))


def test_batches_hold_the_budget(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, prose(rng, rng.choice([0, 1, 5, 40, 300])), "en", "s", 1) for i in range(500)], SCHEMA)
    p = packing.length_buckets(docs, buckets=3, budget=600).toPandas()
    assert len(p) == 500 and (p.n_tokens <= p.pad_to).all() and p.bucket.max() < 3
    g = p.groupby(["bucket", "batch"])
    assert (g.size() * g.pad_to.first() <= np.maximum(600, g.pad_to.first())).all()
    assert (g.place.max() + 1 == g.size()).all()
    o = packing.length_buckets(odd(spark)).toPandas()
    assert len(o) == 10 and o[o.doc_id.isin([1, 2, 7])].n_tokens.eq(0).all() and o[o.doc_id == 4].n_tokens.iloc[0] == 16000
    assert packing.length_buckets(empty(spark)).count() == 0


def test_counting_is_linear_in_white_space(spark):
    import time

    blank = spark.createDataFrame([("a" + " " * (1 << 20) + "\n\t" * 1000 + "b", 2), (" \x0b x", 1), (None, 0), ("\u00a0 y", 2)], "text string, n long")
    blank.select(packing.n_tokens()).collect()
    begin = time.time()
    assert all(r.n == r.want for r in blank.select(packing.n_tokens().alias("n"), F.col("n").alias("want")).collect())
    assert time.time() - begin < 3


def test_packing_against_brute_force(spark):
    """Boundaries over exact lengths beyond any grid, and every document's place in the batches."""
    rng = random.Random(12)
    sizes = [rng.choice([0, 3, 9, 70, 9001, 9013, 12345]) for _ in range(60)]
    docs = spark.createDataFrame([(i, " ".join(["w"] * n), "en", "s", 1) for i, n in enumerate(sizes)], SCHEMA)
    rows = {r.doc_id: r for r in packing.length_buckets(docs, buckets=3, budget=30000).collect()}
    lengths = sorted(set(sizes))
    cost = lambda cut: sum(min(x for x in cut if x >= n) - n for n in sizes)
    best = min((sorted({*c, lengths[-1]}) for n in range(3) for c in combinations(lengths[:-1], n)), key=cost)
    assert sum(rows[i].pad_to - n for i, n in enumerate(sizes)) == cost(best)
    for b in {r.bucket for r in rows.values()}:
        mine = sorted((i for i in rows if rows[i].bucket == b), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
        each = max(1, 30000 // max(1, rows[mine[0]].pad_to))
        assert [(rows[i].batch, rows[i].place) for i in mine] == [divmod(k, each) for k in range(len(mine))]


def test_token_batches_hold_every_token(spark):
    docs = odd(spark)
    plan = {(r.bucket, r.batch) for r in packing.length_buckets(docs, 4, 20000).collect()}
    got = packing.token_batches(docs, 4, 20000).collect()
    assert {(r.bucket, r.batch) for r in got} == plan and sum(len(r.doc_ids) for r in got) == 10
    for r in got:
        assert len(r.ids) == r.pad_to * len(r.lengths) and (len(r.ids) <= 20000 or len(r.lengths) == 1)
        for k, n in enumerate(r.lengths):
            row = r.ids[k * r.pad_to : (k + 1) * r.pad_to]
            assert all(row[:n]) and not any(row[n:])
    assert packing.token_batches(empty(spark)).count() == 0


# --- 8 ---


def test_perspectives(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, "ann", "é"), (2, 0, None, "q"), (2, 0, None, "q"), (3, 0, "system", "only"), (None, 5, "ann", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("idx", F.lit(1)).withColumn("conv", F.lit("mine"))
    got = {(r.conv_id, r.perspective, r.part): r for r in chat.perspectives(df).collect()}
    assert set(got) == {(1, "ann", 0), (1, "bob", 0), (2, "unknown", 0), (None, "ann", 0)}
    a = got[1, "ann", 0]
    assert a.rendered == "<|im_start|>system\nbe<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n<|im_start|>assistant\né<|im_end|>\n"
    assert [a.rendered[int(x) : int(y)] for x, y in (s.split("-") for s in a.mask.split(","))] == ["hi<|im_end|>", "é<|im_end|>"]
    assert got[2, "unknown", 0].n_turns == 2
    parts = {(r.conv_id, r.perspective, r.part): r.rendered for r in chat.perspectives(df, part=2).collect()}
    assert parts[1, "ann", 0] + parts[1, "ann", 1] == a.rendered
    masks = {(r.perspective, r.part): r.mask for r in chat.perspectives(df, part=2).where("conv_id = 1").collect()}
    assert ",".join(masks["ann", k] for k in (0, 1)) == a.mask  # offsets don't depend on the parts
    assert chat.perspectives(df.limit(0)).count() == 0


# --- 9 ---


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance_against_plain():
    rng = random.Random(6)
    for _ in range(4000):
        a = [rng.randint(0, 3) for _ in range(rng.randint(0, 14))]
        b = a[:] if rng.random() < 0.5 else [rng.randint(0, 3) for _ in range(rng.randint(0, 14))]
        for _ in range(rng.randint(0, 4)):
            if b:
                b[rng.randrange(len(b))] = rng.randint(0, 3)
        most, d = rng.randint(0, 6), plain_distance(a, b)
        got = neardup.banded_distance(a, b, most)
        assert got == d if d <= most else got > most


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(9)
    texts = []
    for g in range(25):
        base = prose(rng, rng.randint(60, 400)).split(" ")
        for c in range(rng.randint(1, 12)):
            w = base[:]
            for _ in range(int(len(w) * 0.02 * (c > 0)) + (c > 1)):
                w[rng.randrange(len(w))] = f"edit{rng.random()}"
            texts.append((g, " ".join(w).capitalize() if c % 3 else " ".join(w)))
    texts += [(100 + i, prose(rng, 100)) for i in range(40)] + [(0, texts[0][1])] * 3
    rng.shuffle(texts)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, (_, t) in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in neardup.classes(docs).collect()}
    want = {}
    for i, (g, _) in enumerate(texts):
        want.setdefault(g, i)
    assert {i: want[g] for i, (g, _) in enumerate(texts)} == {i: r.class_id for i, r in got.items()}
    assert sorted(i for i, r in got.items() if r.keep) == sorted(want.values())
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(want.values())


def substituted(rng, words, share):
    """A copy with so many words changed at random places."""
    w = words[:]
    for i in rng.sample(range(len(w)), round(len(w) * share)):
        w[i] = f"edit{rng.random()}".replace(".", "x")
    return w


def test_near_duplicates_star(spark):
    """Copies that are like the original but not like each other are in its class."""
    rng = random.Random(21)
    base = [f"word{rng.randrange(5000)}" for _ in range(200)]
    texts = [" ".join(base)] + [" ".join(substituted(rng, base, 0.15)) for _ in range(80)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    assert [r.class_id for r in neardup.classes(docs).collect()] == [0] * 81


def test_near_duplicate_keys_at_the_threshold():
    """Single pairs at edit similarity 0.9, 0.85 and 0.8 share a key."""
    rng = random.Random(22)
    for share, least in ((0.1, 0.99), (0.15, 0.99), (0.2, 0.95)):
        one = [[f"word{rng.randrange(5000)}" for _ in range(300)] for _ in range(200)]
        two = [substituted(rng, w, share) for w in one]
        keys = [neardup.order_tuples([" ".join(w) for w in x]) for x in (one, two)]
        assert (keys[0] == keys[1]).any(axis=1).mean() >= least


def plain_classes(texts):
    """The least index of each class of edit similarity 0.8, over all pairs of texts."""
    words = [neardup.hash_words([t])[0] for t in texts]
    label = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        if label[i] != label[j] and neardup.alike(words[i], words[j]):
            lo, hi = sorted((label[i], label[j]))
            label = [lo if x == hi else x for x in label]
    return label


def test_near_duplicates_among_texts_with_one_passage(spark):
    """Texts that share a passage are not alike for it; pairs among them are found."""
    rng = random.Random(31)
    word = lambda: f"word{rng.randrange(4000)}"
    passage = [word() for _ in range(90)]
    texts = []
    for i in range(120):
        own = [word() for _ in range(rng.randint(40, 110))]
        texts.append(passage + own if i % 2 else own + passage)
    for i in range(0, 120, 6):
        texts.append(substituted(rng, texts[i], rng.choice([0.02, 0.08, 0.15])))
    texts = [" ".join(t) for t in texts]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.class_id for r in neardup.classes(docs).collect()}
    want = plain_classes(texts)
    assert 100 <= len(set(want)) < 140
    assert [got[i] for i in range(len(texts))] == want


def test_alike_pairs_share_a_rare_word():
    """The join by rare words loses no pair at edit similarity 0.8, for any order of the numbered words."""
    rng, met = random.Random(33), 0
    for _ in range(4000):
        a = [f"w{rng.randrange(12)}" for _ in range(rng.randint(1, 60))]
        b = a[:]
        for _ in range(rng.randint(0, 12)):
            at = rng.randrange(len(b) + 1)
            b = rng.choice((b[:at] + [f"new{rng.random()}"] + b[at:], b[:at] + b[at + 1 :], b[:at] + [f"w{rng.randrange(12)}"] + b[at + 1 :]))
        h = [neardup.hash_words([" ".join(x)]) for x in (a, b)]
        if not a or not b or not neardup.alike(h[0][0], h[1][0]):
            continue
        met += 1
        salt = rng.getrandbits(63)
        one, two = [neardup.labels(*x).tolist() for x in h]
        first = [set(sorted(g, key=lambda x: hash((x, salt)))[: int(0.2 * len(g) + 1e-9) + 1]) for g in (one, two)]
        assert first[0] & first[1]
    assert met > 500


def test_rare_words_join_the_rest(spark):
    """All alike pairs of two classes, without the leaders' help, whatever the size of the blocks."""
    rng = random.Random(34)
    passage = [f"p{i}" for i in range(60)]
    texts = {}
    for i in range(40):
        own = passage + [f"w{rng.randrange(150)}" for _ in range(60)]
        texts[i], texts[100 + i] = own, substituted(rng, own, rng.choice((0.02, 0.1, 0.18)))
    texts[200], texts[201] = texts[0], []
    lines = {i: " ".join(t) for i, t in texts.items()}
    ids = list(lines)
    bags = [x.tobytes() for x in neardup.bags_of([lines[i] for i in ids])]
    schema = "id long, label long, n long, bag binary, t string"
    df = spark.createDataFrame([(i, 0 if i == 200 else i, len(texts[i]), bytearray(g), lines[i]) for i, g in zip(ids, bags, strict=True)], schema)
    prefix, label = neardup.prefixes(df.drop("label"), df.select("id")), df.select("id", "label")
    tested = spark.createDataFrame([(1, 101)], "a long, b long")
    words = {i: neardup.hash_words([t])[0] for i, t in lines.items()}
    want = {(i, j) for i, j in combinations(sorted(lines), 2) if texts[i] and texts[j] and neardup.alike(words[i], words[j])} - {(0, 200), (1, 101)}
    assert len(want) >= 40
    for block in (3, 20, 512):
        rows = [(r.a, r.b) for r in neardup.rare_pairs(prefix, label, tested, block=block).collect()]
        assert len(rows) == len(set(rows)) and want <= set(rows) and not {(0, 200), (1, 101)} & set(rows)
    few = [(r.a, r.b) for r in neardup.rare_pairs(prefix, label, tested, best=1).collect()]
    assert set(few) <= set(rows) and {(i, j) for i, j in few} & want


def test_pairs_near_the_threshold_meet_in_lists(spark):
    """Of texts that nearly all pass the sift, lists come out instead of pairs, and links that join what all pairs join."""
    rng = random.Random(47)
    passage = [f"p{i}" for i in range(80)]
    texts = [passage + [f"w{rng.randrange(30)}" for _ in range(25)] for _ in range(90)]
    texts += [substituted(rng, texts[i], 0.03) for i in range(15)]
    lines = [" ".join(t) for t in texts]
    schema = "id long, label long, n long, bag binary, t string"
    df = spark.createDataFrame([(i, i, len(t), bytearray(g.tobytes()), x) for i, (t, g, x) in enumerate(zip(texts, neardup.bags_of(lines), lines, strict=True))], schema)
    prefix, label = neardup.prefixes(df.drop("label"), df.select("id")), df.select("id", "label")
    words = [neardup.hash_words([x])[0] for x in lines]
    want = {(i, j) for i, j in combinations(range(len(texts)), 2) if neardup.alike(words[i], words[j])}

    def joined(pairs):
        top = list(range(len(texts)))
        for a, b in pairs:
            old, new = sorted((top[a], top[b]))[::-1]
            top = [new if x == old else x for x in top]
        return top

    for rooms in (1, 3):
        lists = materialise(neardup.rare_lists(prefix, label, rooms), "lists")
        rows = lists.collect()
        pairs = {p for r in rows for p in zip(r.a, r.b, strict=True)}
        assert want <= pairs and len(pairs) > 1500 and len(rows) <= 4 * rooms * (rooms + 1) // 2
        found = {(r.a, r.b) for r in neardup.aligned(lists, None, df, label).collect()}
        assert found <= want and joined(found) == joined(want) and len(found) <= len(texts) * rooms
        assert not neardup.aligned(lists, lists, df, label).collect()  # nothing is aligned twice


def test_only_classes_of_which_pairs_were_held_back_meet_again(spark):
    """The second pass of the join by rare words takes what the first may have missed, and that alone."""
    rng = random.Random(51)
    texts = [[f"p{i}" for i in range(80)] + [f"w{rng.randrange(30)}" for _ in range(25)] for _ in range(12)]
    other = [f"q{i}" for i in range(100)]
    texts += [other + ["w1", "w2"], other + ["w1", "w3"]]
    lines, classes = [" ".join(t) for t in texts], [0] * 6 + [6] * 6 + [12, 13]
    rows = zip(texts, neardup.bags_of(lines), lines, classes, strict=True)
    df = spark.createDataFrame([(i, c, len(t), bytearray(g.tobytes()), x) for i, (t, g, x, c) in enumerate(rows)], "id long, label long, n long, bag binary, t string")
    prefix, label = neardup.prefixes(df.drop("label"), df.select("id")), df.select("id", "label")
    all_of = materialise(neardup.rare_lists(prefix, label, 1), "lists")
    first = materialise(neardup.rare_lists(prefix, label, 1, best=2), "lists")
    pairs, few = ({p for r in x.collect() for p in zip(r.a, r.b, r.more, strict=True)} for x in (all_of, first))
    assert not any(more for _, _, more in pairs) and {more for a, _, more in few if a < 12} == {True} and (12, 13, False) in few
    assert len(few) < len(pairs)
    assert sorted(neardup.cut_short(first, label, label).collect()) == [(i, 0 if i < 6 else 6) for i in range(12)]
    assert neardup.cut_short(all_of, label, label) is None
    one = spark.createDataFrame([(i, 0) for i in range(12)], "id long, label long")
    assert neardup.cut_short(first, label, one) is None


def test_texts_of_which_no_pair_was_held_back_meet_once(spark, monkeypatch):
    """Texts near the threshold, each a class of its own, are joined by rare words once; before, all of them twice."""
    rng = random.Random(52)
    passage = [f"p{i}" for i in range(150)]
    docs = spark.createDataFrame([(i, " ".join(passage + [f"w{rng.randrange(400)}" for _ in range(60)])) for i in range(40)], "doc_id long, text string")
    written = []
    monkeypatch.setattr(neardup, "materialise", lambda df, label: [written.append(label), materialise(df, label)][1])
    rows = neardup.classes(docs).collect()
    assert len(rows) == 40 and len({r.class_id for r in rows}) > 20
    assert written.count("met") == 1 and len(written) <= 30


def test_held_back_pairs_are_marked():
    """However the rows come, the least of two classes stay, once each, and say whether there were more."""
    rng = random.Random(53)
    rows = np.array([[a, a + 10, rng.randrange(9), 100 + rng.randrange(12), 200 + a, 0] for a in range(6) for _ in range(rng.choice((1, 2, 3, 30)))])
    rows[:, 2] = rows[:, 3] % 7  # one number for a pair
    want = {a: sorted({(r[2], r[3]) for r in rows.tolist() if r[0] == a}) for a in range(6)}
    for best in (1, 3, None):
        found = np.zeros((0, 6), np.int64)
        for part in np.array_split(np.concatenate([rows, rows[::2]]), 5):
            found = neardup._distinct(np.concatenate([found, part]), best)
        got = {a: [r for r in found.tolist() if r[0] == a] for a in range(6)}
        for a, g in got.items():
            assert [(r[2], r[3]) for r in g] == want[a][:best] and {r[5] for r in g} == {int(best is not None and len(want[a]) > best)}


def test_relabelled_is_components_of_all_links(spark):
    rng = random.Random(54)
    old, new = ([(rng.randrange(60), rng.randrange(60)) for _ in range(k)] for k in (25, 20))
    frame = lambda x: spark.createDataFrame(x, "a long, b long")
    label = neardup.components(frame(old))
    got = sorted(neardup.relabelled(label, frame(new)).collect())
    assert got == sorted(neardup.components(frame(old + new)).collect()) and len(got) == len({r.id for r in got})
    assert sorted(neardup.relabelled(label, frame(new).limit(0)).collect()) == sorted(label.collect())


def test_bags_are_a_bound_where_slots_are_full():
    """Never more edits than the words of two texts are apart, and that many if one word fills a slot in both."""
    rng = random.Random(43)
    texts = [" ".join(["very"] * rng.choice([0, 200, 254, 255, 256, 400, 900]) + ["often"] * rng.choice([0, 300]) + prose(rng, rng.randint(0, 120)).split()) for _ in range(60)]
    words = [Counter(t.split()) for t in texts]
    n = np.array([w.total() for w in words])
    a, b = (np.array(x) for x in zip(*combinations(range(60), 2), strict=True))
    bags = neardup.bags_of(texts)
    lack = neardup.bags_lack(bags[a], bags[b], n[a], n[b])
    real = np.array([max(n[i], n[j]) - (words[i] & words[j]).total() for i, j in zip(a, b, strict=True)])
    assert (lack <= real).all()
    one = [i for i in range(60) if words[i]["very"] > 255 and not words[i]["often"]]
    both = np.isin(a, one) & np.isin(b, one)
    assert both.sum() > 50 and (real - lack)[both].max() < 20


def test_pairs_leave_at_their_first_common_word():
    """Each pair of texts with a common word is held back at all words but the first one, and a later one out of reach."""
    rng = random.Random(41)
    lists = [sorted(rng.sample(range(200), rng.randint(1, 90))) for _ in range(40)]
    given = {}
    for w in range(200):
        mine = [i for i, x in enumerate(lists) if w in x]
        table = pa.table({"before": pa.array([lists[i][max(0, lists[i].index(w) - neardup.BEFORE) : lists[i].index(w)] for i in mine], pa.list_(pa.int64()))})
        before = neardup._before(table, np.full(len(mine), w))
        p, q = (np.array(x, int) for x in zip(*combinations(range(len(mine)), 2), strict=True)) if len(mine) > 1 else (np.zeros(0, int),) * 2
        met = neardup._met_before(before[p], before[q], np.full(len(p), w))
        for i, j, m in zip(p, q, met, strict=True):
            near = lambda k: set(lists[mine[k]][max(0, lists[mine[k]].index(w) - neardup.BEFORE) : lists[mine[k]].index(w)])  # noqa: B023,E731
            assert m == bool(near(i) & near(j))
            if not m:
                given.setdefault((mine[i], mine[j]), []).append(w)
    common = {(i, j): min(x) for i, j in combinations(range(40), 2) if (x := set(lists[i]) & set(lists[j]))}
    assert {k: v[0] for k, v in given.items()} == common and sum(map(len, given.values())) < 1.1 * len(common)


def test_near_duplicates_that_share_large_keys_only(spark):
    """100 pairs at edit similarity 0.82, of which two thirds are one passage common to all texts: all are found."""
    rng = random.Random(36)
    word = lambda: f"word{rng.randrange(4000)}"
    passage = [word() for _ in range(200)]
    texts = []
    for _ in range(100):
        own = [word() for _ in range(100)]
        changed = own[:]
        for i in rng.sample(range(100), 54):
            changed[i] = word()
        texts += [passage + own, passage + changed]
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.class_id for r in neardup.classes(docs).collect()}
    assert [got[i] for i in range(200)] == [i - i % 2 for i in range(200)]


def test_words_of_scripts_without_blanks(spark):
    """A character is a word there: texts that differ in a few are alike."""
    rng = random.Random(37)
    base = [chr(0x4E00 + rng.randrange(3000)) for _ in range(400)]
    other = [chr(0x4E00 + rng.randrange(3000)) for _ in range(400)]
    changed = ["\u4e00" if i % 50 == 7 else x for i, x in enumerate(base)]
    docs = spark.createDataFrame([(i, "".join(t), "zh", "s", 1) for i, t in enumerate((base, changed, other))], SCHEMA)
    assert [r.class_id for r in neardup.classes(docs).orderBy("doc_id").collect()] == [0, 0, 2]
    hashes, counts = neardup.hash_words(["ab \u4e00\u4e01cd", "\u4e01", "ab", "caf\u00e9"])
    assert counts.tolist() == [4, 1, 1, 1] and hashes[2] == hashes[4] and hashes[0] == hashes[5]


def test_bags_rule_out_no_alike_pair():
    rng = random.Random(35)
    for _ in range(2000):
        a = [f"w{rng.randrange(30)}" for _ in range(rng.choice([1, 3, 20, 600]))]
        b = [x for x in a if rng.random() > 0.08] + [f"w{rng.randrange(30)}" for _ in range(rng.randint(0, len(a) // 8))]
        texts = [" ".join(a), " ".join(b)]
        h = [neardup.hash_words([t])[0] for t in texts]
        bags = neardup.bags_of(texts)
        if neardup.alike(*h):
            assert neardup.bags_allow(bags[:1], bags[1:], np.array([len(a)]), np.array([len(b)]))[0]
    assert not neardup.bags_allow(*[neardup.bags_of([x]) for x in ("a b c d e", "f g h i j")], np.array([5]), np.array([5]))[0]


def test_near_duplicate_recall_at_the_threshold(spark):
    """Against all pairs of the smallest table: links at edit similarity 0.8 that the classes hold."""
    path = "/root/testdata/sf0.001/documents.parquet"
    docs = spark.read.parquet(path)
    rows = docs.select("doc_id", "text").collect()
    words = {r.doc_id: neardup.hash_words([r.text])[0] for r in rows}
    got = {r.doc_id: r.class_id for r in neardup.classes(docs).collect()}
    pairs = [(i, j) for i, j in combinations(sorted(words), 2) if len(words[i]) and len(words[j]) and neardup.alike(words[i], words[j])]
    assert pairs and sum(got[i] == got[j] for i, j in pairs) >= 0.9 * len(pairs)


def test_near_duplicates_odd_rows(spark):
    docs = odd(spark)
    rows = neardup.classes(docs).collect()
    assert len(rows) == 10
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.class_id)
    assert by[5] == {4} and by[1] == {1} and by[2] == {1} and by[7] == {7} and by[None] == {None}
    kept = neardup.one_of_each(docs).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept if r.doc_id in (1, 2, 4, 5, 6)) == sorted([(1, ""), (4, next(r.text for r in docs.collect() if r.doc_id == 4)), (6, "x"), (6, "y other")])
    assert neardup.classes(empty(spark)).count() == 0


def test_components_follow_chains(spark):
    n = 70
    pairs = spark.createDataFrame([(i, i + 1) for i in range(n) if i != 30], "a long, b long")
    got = {r.id: r.label for r in neardup.components(pairs).collect()}
    assert got == {i: 0 if i <= 30 else 31 for i in range(n + 1)}


# --- 10 ---


def labelled(spark, n=900):
    rng = random.Random(8)
    bad = ["vilewort", "scumbly", "trashen"]
    rows, labels = [], []
    for i in range(n):
        w = prose(rng, rng.randint(5, 80)).split(" ")
        toxic = int(i % 6 == 0)
        for _ in range(2 * toxic):
            w[rng.randrange(len(w))] = rng.choice(bad)
        rows.append((i, " ".join(w), rng.choice(["en", "de"]), "s", 1))
        labels.append((i, 1, toxic))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    got = toxicity.scored_documents(docs.withColumn("toxic", F.lit(9)), labels).join(labels, "doc_id").toPandas()
    assert len(got) == 900
    assert {int(i) for i in got[got.held_out].doc_id} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0}
    held = got[got.held_out]
    assert (held.predicted == held.toxic).mean() > 0.97 and (held.flagged == (held.toxic == 1)).mean() > 0.95


def test_toxicity_odd_rows(spark):
    docs, labels = labelled(spark)
    m = toxicity.fit(docs, labels)
    out = toxicity.with_scores(odd(spark), m, "tox").collect()
    assert len(out) == 10 and all(0 <= r.tox <= 1 and r.score == "mine" for r in out)
    assert toxicity.scored_documents(empty(spark), labels).count() == 0
    none = toxicity.scored_documents(odd(spark), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    long = prose(random.Random(1), 60000)
    assert m.score([long + " vilewort scumbly trashen"])[0] > m.score([long])[0]  # whole texts, not prefixes
    assert m.score(["vilewort scumbly", "dalan"])[1] == pytest.approx(m.score(["dalan", "vilewort scumbly"])[0])


def test_gradients_against_differences():
    """One step of plain descent on each dense weight moves the loss as its gradient says."""
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(3, 30)) + (" vile" if i % 3 == 0 else "") for i in range(40)]
    toxic = [int(i % 3 == 0) for i in range(40)]
    data = toxicity.hash_words(texts)

    def loss(m):
        s = np.clip(m.score_hashed(*data), 1e-9, 1 - 1e-9)
        return -np.mean([np.log(x if t else 1 - x) for x, t in zip(s, toxic, strict=True)])

    start = toxicity.train(*data, toxic, toxicity.Params(epochs=0, buckets=1 << 10))
    once = toxicity.train(*data, toxic, toxicity.Params(epochs=1, batch=40, rate=1e-4, buckets=1 << 10))
    assert loss(once) < loss(start)
    # Adam's first step is the rate against the sign of the gradient: held against differences.
    for p, q in ((start.bias, once.bias), (start.out, once.out), *zip((k.ravel() for k in start.kernels), (k.ravel() for k in once.kernels), strict=True)):
        moved, checked = q - p, 0
        for i in range(0, len(p), 7):
            old = p[i]
            p[i] = old + 1e-2
            up = loss(start)
            p[i] = old - 1e-2
            down = loss(start)
            p[i] = old
            if abs(up - down) > 1e-4:
                assert np.sign(up - down) == -np.sign(moved[i])
                checked += 1
    assert loss(start) == pytest.approx(loss(toxicity.train(*data, toxic, toxicity.Params(epochs=0, buckets=1 << 10))))


def test_sample_is_bounded_and_whole(spark):
    assert toxicity.fitting([5, 9, 3, 1], 9) == [0, 2, 3] and toxicity.fitting([], 5) == []
    docs, labels = labelled(spark, 200)
    rows = toxicity.sample(docs.union(docs.withColumn("text", F.concat(F.lit("zz "), "text"))), labels, toxicity.Params(words=1000))
    text = {r.doc_id: r.text for r in docs.collect()}
    assert 10 < len(rows) < 200 and sum(r.n for r in rows) <= 1000
    assert all(np.frombuffer(r.words, np.uint64).tolist() == toxicity.hash_words([text[r.doc_id]])[0].tolist() for r in rows)


def test_every_labelled_document_is_learned_from(spark):
    docs, labels = labelled(spark)
    p = toxicity.Params(rows=40, words=2000, buckets=1 << 12)  # what a learner has, not what all have
    text, mark = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.toxic for r in labels.collect()}
    fifth = {i: zlib.crc32(str(i).encode()) % 5 for i in text}
    rows = toxicity.labelled(docs.repartition(5), labels)
    assert sorted((r.text, r.toxic, r.late) for r in rows.collect()) == sorted((text[i], mark[i], fifth[i] == 1) for i in text if fifth[i])
    own = [i for i in text if fifth[i] > 1]
    one, all_, n1, n, words = toxicity.counted(rows.where("not late"), p)
    assert (n1, n) == (sum(mark[i] for i in own), len(own)) and words == sum(len(toxicity.hash_words([text[i]])[0]) for i in own)
    m = toxicity.blank(p, np.random.default_rng(0))
    seen = [(mark[i], {int(r) for x in m.rows(toxicity.hash_words([text[i]])[0]) for r in x}) for i in own]
    assert all(all_[r] == sum(r in rows for _, rows in seen) and one[r] == sum(r in rows for y, rows in seen if y) for r in np.flatnonzero(all_)[::37])
    got = toxicity.scored_documents(docs, labels, p).where("held_out").join(labels, "doc_id").toPandas()
    assert (got.predicted == got.toxic).mean() > 0.97


def test_counts_stand_for_rows():
    rng = np.random.default_rng(4)
    scores, toxic, times = np.round(rng.random(60), 2), rng.integers(0, 2, 60), rng.integers(1, 5, 60)
    langs, m = [["en", "de"][i % 2] for i in range(60)], toxicity.blank(toxicity.Params(buckets=8), rng)
    each = np.repeat(np.arange(60), times)
    assert toxicity.calibrate(scores, toxic, langs, times=times) == pytest.approx(toxicity.calibrate(scores[each], toxic[each], [langs[i] for i in each]))
    assert toxicity.scaled(m, scores, toxic, times) == pytest.approx(toxicity.scaled(m, scores[each], toxic[each]))


def test_thresholds_of_rare_languages_stay_near_that_of_all():
    rng = np.random.default_rng(3)
    scores, toxic = rng.random(400), rng.integers(0, 2, 400)
    got = toxicity.calibrate(scores, toxic, ["en"] * 390 + ["fr"] * 10)
    assert set(got) == {"", "en", "fr"} and abs(got["fr"] - got[""]) < 0.2 * 1.0


def test_pooling_against_plain_loops():
    rng = np.random.default_rng(1)
    p = toxicity.Params(buckets=64, filters=3)
    m = toxicity.Model(p, rng.normal(size=(128, 8)).astype(np.float32), [rng.normal(size=(w, 8, 3)).astype(np.float32) for w in p.widths], np.zeros(9, np.float32), np.ones(10, np.float32))
    texts = ["a b c d e", "", "a", "x y"]
    h, c = toxicity.hash_words(texts)
    got, at = m.pooled(*m.rows(h), c), 0
    for t, n in enumerate(c):
        a, b = m.rows(h[at : at + n])
        x = np.concatenate([m.table[a] + m.table[b], np.zeros((6, 8))])
        want = [max(sum(x[i + o] @ k[o][:, f] for o in range(w)) for i in range(n + 3)) for w, k in zip(p.widths, m.kernels, strict=True) for f in range(3)]
        assert np.allclose(got[t], want, atol=1e-4)
        at += n


# --- pipeline ---


def test_pipeline_stages(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    from gleaner.llm.common import new_path, table

    rng = random.Random(5)
    docs, labels = labelled(spark, 300)
    passage = prose(rng, 60)
    extra = [(1000 + i, prose(rng, 50) + "\n" + passage + "\n" + prose(rng, 40), "en", "s", 9) for i in range(6)]
    base = prose(rng, 200)
    extra += [(2000 + i, base.replace(base.split(" ")[7], f"edit{i}"), "en", "t", 9) for i in range(5)]
    docs = docs.union(spark.createDataFrame(extra, SCHEMA))
    sf = new_path(spark, "sf")
    docs.write.parquet(f"{sf}/documents.parquet")
    labels.write.parquet(f"{sf}/labels.parquet")
    now, seen = table(spark, sf, "documents"), {}
    for name, stage in pipeline.STAGES[:-1]:
        now = stage(spark, now, sf)
        assert now.columns == docs.columns
        path = new_path(spark, "stage")
        now.write.parquet(path)
        now = spark.read.parquet(path)
        seen[name] = {r.doc_id: r for r in now.collect()}
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    assert len(toxic & set(seen["toxicity"])) < 0.1 * len(toxic)
    assert len(seen["toxicity"]) > 0.95 * (311 - len(toxic))
    assert sum(passage in r.text for r in seen["line dedup"].values()) == 1
    assert {1000, 1005} <= set(seen["line dedup"])
    assert len({2000 + i for i in range(5)} & set(seen["near duplicates"])) == 1
    packed = pipeline.STAGES[-1][1](spark, now, sf)
    assert packed.count() == now.count()
    assert pipeline.run(spark, sf).count() == now.count()
