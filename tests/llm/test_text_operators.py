"""Operators 11 to 13 against brute force and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from gleaner.llm import audit, suffixes, variants

from test_operators import empty, odd

# --- 11 ---

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, chars=6, times=5, ratio=5, noise=199):
    n = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % noise == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    words = {w: k for w, k in n.items() if len(w) >= chars and k >= times}
    form, out = {}, {}
    for w in words:
        close = [x for x in words if near(w, x)]
        best = min(close, key=lambda x: (-words[x], x)) if close else None
        form[w] = best if best and words[best] >= ratio * words[w] else None
        out[w] = len(close)
    def root(w):
        return root(form[w]) if form[w] else w
    return {(w, form[w], root(w), k, out[w], words[form[w]] if form[w] else None) for w, k in words.items()}


def test_variants_equal_brute_force(spark):
    rng = random.Random(4)
    base = ["colour", "kolours", "straße", "élévation", "Repeat", "aaaaaaa", "abababab", "commence"]
    def typo(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcé÷") + w[i:], w[:i] + rng.choice("xyzÀ") + w[i + 1 :], w])
    pool = base * 30 + [typo(w) for w in base for _ in range(12)] + [typo(typo(w)) for w in base for _ in range(8)]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(60))) for i in range(120)] + [(200 + i, "planetary " + "planetar " * 8 + "planeta " * 60) for i in range(9)] + [(None, "colour's Colour-kolours " * 7), (3, None), (4, ""), (4, "a" * 3000 + " " + "a" * 2999), (5, "1 2 3")] * 5
    got = variants.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), noise=11).collect()
    want = brute_variants(rows, noise=11)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert any(f for _, f, *_ in want) and any(r != f for _, f, r, *_ in want if f) and max(x[4] for x in want) > 3


def test_delete_keys_are_those_of_the_strings():
    words = ["banana", "anana", "bnana", "aab", "ab", "é÷x", "", "a"]
    which, keys = variants.delete_keys(words)
    by = defaultdict(set)
    for w, k in zip(which.tolist(), keys.tolist(), strict=True):
        by[words[w]].add(k)
    for a in words:
        assert len(by[a]) == 1 + len({a[:i] + a[i + 1 :] for i in range(len(a))})
        for b in words:
            strings = [{x} | {x[:i] + x[i + 1 :] for i in range(len(x))} for x in (a, b)]
            assert bool(by[a] & by[b]) == bool(strings[0] & strings[1])


def test_variants_of_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd(spark).collect()]
    assert {tuple(r) for r in variants.spelling_variants(odd(spark)).collect()} == brute_variants(rows)
    assert variants.spelling_variants(empty(spark)).count() == 0


# --- 12 ---


def brute_removed(rows, length, keep_first):
    """The rows' places that go, and what is left."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, hashlib.md5(repr(rows[i]).encode()).hexdigest()))
    texts, at = [(t or "").encode() for _, t in rows], defaultdict(list)
    for i in order:
        for p in range(len(texts[i]) - length + 1):
            at[texts[i][p : p + length]].append((i, p))
    gone = [set() for _ in rows]
    for places in at.values():
        for i, p in places:
            if len(places) > 1 and not (keep_first and (rows[i], p) == (rows[places[0][0]], places[0][1])):
                gone[i].update(range(p, p + length))
    out = []
    for (doc_id, _), t, g in zip(rows, texts, gone, strict=True):
        out.append((doc_id, len(t), len(g), sum(x - 1 not in g for x in g), bytes(b for k, b in enumerate(t) if k not in g)))
    return Counter(out)


@pytest.mark.parametrize("keep_first", [False, True])
def test_repeated_strings_equal_brute_force(spark, keep_first):
    """Few segments an anchor in suffix order; beyond `bound`, by nodes: both the same. Ids differ where texts do, so that
    the first of equal ids plays no part."""
    rng = random.Random(7)
    phrases = ["".join(rng.choice("abcé ") for _ in range(rng.randint(8, 60))) for _ in range(10)]
    def text():
        return "".join(rng.choice(phrases) if rng.random() < 0.6 else "".join(rng.choice("xyzü ") for _ in range(rng.randint(1, 25))) for _ in range(rng.randint(0, 8)))
    rows = [(i, text()) for i in range(40)]
    rows += [(None, rows[3][1]), (70, rows[7][1]), (71, rows[7][1]), (71, rows[7][1]), (90, None), (91, ""), (92, "a" * 300), (93, "ab" * 200), (94, "a" * 50), (95, "q" * 20)]
    want = brute_removed(rows, 20, keep_first)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("kept", F.lit("mine")).withColumn("key", F.lit(1))
    for bound, widths in ((4096, (20, 4, 1)), (1, (3, 1))):
        got = suffixes.without_repeats(docs, 20, 6, keep_first, bound, widths)
        assert got.columns == ["doc_id", "text", "key", "n_bytes", "n_removed", "n_spans", "kept"]
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()) == want


def test_long_texts_are_worked_on_in_pieces(monkeypatch):
    """Pieces cut segments, but every window is in one segment of its text, with the anchor that its bytes have."""
    rng = random.Random(2)
    data = bytes(rng.choice(b"abcd") for _ in range(700)) + b"x" * 90
    whole = list(suffixes.segments([data, b"short"], 40, 8))
    monkeypatch.setattr(suffixes, "PIECE", 64)
    cut = list(suffixes.segments([data, b"short"], 40, 8))
    anchors = lambda found: {w: start + off for _, start, size, off, _, _ in found for w in range(start, start + size - 39)}
    assert anchors(whole) == anchors(cut) and set(anchors(cut)) == set(range(len(data) - 39)) and len(cut) > len(whole)


def test_previous_factors_equal_brute_force():
    rng = random.Random(1)
    for _ in range(100):
        t = "".join(rng.choice("ab") for _ in range(rng.randint(1, 25)))
        common = lambda i, j: next((k for k in range(len(t)) if max(i, j) + k >= len(t) or t[i + k] != t[j + k]), 0)  # noqa: B023, E731
        order = sorted(range(len(t)), key=lambda i: t[i:])  # noqa: B023
        factor, source = suffixes.previous_factors(order, [0] + [common(a, b) for a, b in zip(order, order[1:], strict=False)])
        for p, f, s in zip(order, factor, source, strict=True):
            assert f == max([common(p, j) for j in range(p)], default=0)
            assert (s == -1) == (f == 0) and (f == 0 or (s < p and common(p, s) == f))


def test_repeated_strings_of_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd(spark).collect()]
    got = suffixes.removed_bytes(odd(spark)).collect()
    gone = {(r.doc_id, r.n_bytes): (r.n_removed, r.kept_sha256) for r in got}
    assert len(got) == len(rows)
    long = next(t for i, t in rows if i == 4).encode()
    none = hashlib.sha256(b"").hexdigest()
    assert gone[4, len(long)] == gone[5, len(long)] == (len(long), none) and gone[1, 0] == (0, none)
    assert gone[8, 600] == (600, none)  # 300 times the same letter of two bytes
    assert suffixes.removed_bytes(empty(spark)).count() == 0


# --- 13 ---


def brute_audit(docs, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    least, rows = {}, []
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= x <= "Z" for x in t) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and least[t] < i}
        rows.append((lang or "", {k for k, x in fails.items() if x}, i in good and i is not None, i in toxic and i is not None))
    out, total = {}, Counter()
    for part in {r[0] for r in rows}:
        for o in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            gone = []
            for k, f in enumerate(o):
                now = [r for r in left if f in r[1]]
                total[part, f] += len(now)
                redundant = sum(f in r[1] for r in gone)
                left, gone = [r for r in left if f not in r[1]], gone + now
                out[part, o, k + 1] = (len(left), len(now), redundant, sum(r[1] == {f} for r in rows if r[0] == part), sum(r[2] for r in now), sum(r[3] for r in now))
    return {k + v + (total[k[0], k[1][k[2] - 1]],) for k, v in out.items()}


def test_audit_equals_brute_force(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["w%d" % rng.randrange(n), "#x", "ABC", "é"][: rng.randint(1, 4)]) for _ in range(rng.choice([0, 5, 199, 200, 260]))) for n in (3, 99, 100, 300) for _ in range(12)]
    docs = [(rng.randrange(60), rng.choice(texts), rng.choice(["en", "fr", None, ""])) for _ in range(150)] + [(None, texts[0], "en"), (None, None, None), (7, None, "fr"), (8, "", "fr"), (8, " x \x1f y\x0b", "fr")]
    labels = [(rng.randrange(70), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)] + [(None, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("mask", F.lit("mine")).withColumn("good", F.lit(3))
    got = audit.filter_audit(d.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))).collect()
    assert {tuple(r) for r in got} == brute_audit(docs, labels) and len(got) == 3 * 600


def test_parity_sums_give_back_the_cells(spark):
    rng = random.Random(3)
    rows = [(rng.choice("pq"), rng.random() < 0.5, rng.random() < 0.5, rng.randrange(32)) for _ in range(500)]
    masked = spark.createDataFrame(rows, "part string, good boolean, toxic boolean, mask int")
    got = {(r.part, r["mask"]): (r.n, r.good, r.toxic) for r in audit.cells(audit.parity_sums(masked)).collect()}
    assert len(got) == 64
    for p in "pq":
        for m in range(32):
            own = [r for r in rows if r[0] == p and r[3] == m]
            assert got[p, m] == (len(own), sum(r[1] for r in own), sum(r[2] for r in own))


def test_audit_of_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int")
    docs = [(r.doc_id, r.text, r.lang) for r in odd(spark).collect()]
    assert {tuple(r) for r in audit.filter_audit(odd(spark), labels).collect()} == brute_audit(docs, [(4, 1, 0)])
    assert audit.filter_audit(empty(spark), labels).count() == 0
    assert audit.filter_audit(odd(spark), labels.limit(0)).count() == 600 * len({x[2] or "" for x in docs})
