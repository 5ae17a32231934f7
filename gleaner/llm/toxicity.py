"""Toxicity: a convolutional text classifier in numpy.

Words are hashed twice into a table of embeddings (the sum of both rows is the word's vector, so that two words are
seldom alike); filters of several widths run over whole texts; each filter's maximum over the text goes to a logistic
layer. Vectors start near 0, so that words not seen in training move no
filter; one component starts at the shrunk log odds of the word in the labelled documents.

Training reads every labelled document that is not held out, whole. One pass counts, for each row of the table, the toxic
and all documents that have it. Then, `epochs` times, about `rows` documents (fewer of long ones, `words` words) go to a
learner each, which is a task: it starts from the common model, descends over its documents once and gives out how far it
moved each vector and weight. Their means (of a word's vector: over the steps that moved it) are the next common model. They
are sums of whole numbers, so the order of tasks is no matter. A fifth of the labelled documents trains no filter: on all of
it the score is scaled, so that 0.5 is the even chance, and the thresholds for decisions are calibrated for each language,
drawn to that of all languages where a language has few labels; for this, documents are counted by 64ths of their logit. The
score itself sees the text only. The driver holds the model and these counts, never a document. Scoring is a narrow map over
whole texts.

Nulls: a null text is scored as empty; a null language has the threshold of all languages together; null labels are not
learned from. A document with several labels is toxic if one says so; of rows that repeat a doc_id, the one with the least
text is learned from. Repeated rows score alike. Without any label, or with one class only, the score is the share of toxic
labels, 0.5 if there are none. Extra columns are kept by `with_scores`, but for one with the score's name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .words import hash_words

#: Bytes of text that are scored at once.
BLOCK = 1 << 20
#: Parts of one in a learner's sums, and of a logit in the counts that scale and thresholds come from.
UNIT, LOGIT = 1 << 20, 64


@dataclass(frozen=True)
class Params:
    rows: int = 5000
    words: int = 4_000_000
    buckets: int = 1 << 17
    dim: int = 8
    filters: int = 16
    widths: tuple[int, ...] = (1, 2, 3)
    epochs: int = 3
    batch: int = 64
    rate: float = 0.003
    seed: int = 11


def _first(y: np.ndarray, most: np.ndarray, begin: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Where each column has its maximum first, for each text's windows."""
    at = np.where(y == np.repeat(most, np.diff(begin), axis=0), np.arange(len(y), dtype=np.int64)[:, None], len(y))
    return np.minimum.reduceat(at, own, axis=0)[::2]


@dataclass
class Model:
    params: Params
    table: np.ndarray
    kernels: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    constant: float | None = None
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)

    def rows(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.uint64(self.params.buckets - 1)
        return (hashes & low).astype(np.int64), ((hashes >> np.uint64(32)) & low).astype(np.int64) + self.params.buckets

    def pooled(self, a: np.ndarray, b: np.ndarray, counts: np.ndarray, where: bool = False):
        """Maxima (texts x filters) before the bias; with where, also the places of these maxima. Texts stand apart by as many
        zero vectors as the widest filter; a text's windows start at its words and once behind them, so none spans two."""
        gap, n = max(self.params.widths), len(counts)
        begin = np.concatenate([[0], np.cumsum(counts + gap)])
        own = np.stack([begin[:-1], begin[:-1] + counts + 1], 1).ravel()
        x = np.zeros((begin[-1] + gap, self.params.dim), np.float32)
        index = np.arange(len(a)) + np.repeat(np.arange(n) * gap, counts)
        x[index] = self.table[a]
        x[index] += self.table[b]
        most, places = [], []
        for w, k in zip(self.params.widths, self.kernels, strict=True):
            y = x[: begin[-1]] @ k[0]
            for o in range(1, w):
                y += x[o : begin[-1] + o] @ k[o]
            m = np.maximum.reduceat(y, own, axis=0)[::2]
            most.append(m)
            if where:
                places.append(_first(y, m, begin, own))
        return (np.concatenate(most, 1), x, index, np.concatenate(places, 1)) if where else np.concatenate(most, 1)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return self.score_hashed(*hash_words(texts))

    def score_hashed(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(counts), self.constant)
        z = np.maximum(self.pooled(*self.rows(hashes), counts) + self.bias, 0) @ self.out[:-1] + self.out[-1]
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * z.astype(np.float64) + self.scale[1], -30, 30)))


def seen(rows: np.ndarray, counts: np.ndarray, y: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of the table: how many toxic documents, and how many of all, have it."""
    pair = np.unique(np.repeat(np.arange(len(counts)), counts) * size + rows)
    doc, row = pair // size, pair % size
    return np.bincount(row, y[doc], size), np.bincount(row, minlength=size)


def contrast(one: np.ndarray, all_: np.ndarray, n1: float, n: float) -> np.ndarray:
    """For each row of the table, how many standard errors beyond 1.5, at most 6, the log odds of a toxic document differ
    between documents with and without it: where vectors start, since a maximum alone passes a gradient to few words.
    n1 of n documents are toxic."""
    none, n0 = all_ - one, n - n1
    odds = np.log((one + 0.5) / (n1 - one + 0.5)) - np.log((none + 0.5) / (n0 - none + 0.5))
    z = odds / np.sqrt(1 / (one + 0.5) + 1 / (none + 0.5))
    return np.where(all_ > 0, np.sign(z) * np.clip(np.abs(z) - 1.5, 0, 6), 0).astype(np.float32)


def blank(params: Params, rng: np.random.Generator) -> Model:
    f, d = params.filters, params.dim
    table = rng.normal(0, 0.01, (2 * params.buckets, d)).astype(np.float32)
    kernels = [rng.normal(0, 0.5 / w**0.5, (w, d, f)).astype(np.float32) for w in params.widths]
    n = f * len(params.widths)
    return Model(params, table, kernels, np.zeros(n, np.float32), np.concatenate([rng.normal(0, 0.3, n), [0]]).astype(np.float32))


def primed(model: Model, one: np.ndarray, all_: np.ndarray, n1: float, n: float) -> Model:
    """The model before its first step, from counts of documents; constant if they are of one class."""
    if not 0 < n1 < n:
        model.constant = float(n1 / n) if n else 0.5
        return model
    model.table[:, 0] += 0.25 * contrast(one, all_, n1, n)
    for k in model.kernels:
        k[:, 0] = np.abs(k[:, 0])
    return model


class Learner:
    """Adam on the logistic loss. Backwards, only the places of the maxima count. `hits`: steps that moved a row of the table."""

    def __init__(self, model: Model):
        self.model, self.step = model, 0
        self.dense = [*model.kernels, model.bias, model.out]
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.dense]
        self.second = np.zeros(len(model.table), np.float32)
        self.hits = np.zeros(len(model.table), np.int64)

    def learn(self, a: np.ndarray, b: np.ndarray, counts: np.ndarray, y: np.ndarray) -> None:
        model, params = self.model, self.model.params
        f = params.filters
        most, x, index, places = model.pooled(a, b, counts, where=True)
        h = most + model.bias
        act = np.maximum(h, 0)
        p = 1 / (1 + np.exp(-(act @ model.out[:-1] + model.out[-1])))
        g = (p - y) / len(y)
        gout = np.concatenate([act.T @ g, [g.sum()]])
        gh = np.outer(g, model.out[:-1]) * (h > 0)
        gx, grads = np.zeros_like(x), []
        for i, (w, k) in enumerate(zip(params.widths, model.kernels, strict=True)):
            part, where = gh[:, i * f : (i + 1) * f], places[:, i * f : (i + 1) * f]
            gk = np.zeros_like(k)
            for o in range(w):
                gk[o] = np.einsum("nf,nfd->df", part, x[where + o])
                np.add.at(gx, where + o, part[:, :, None] * k[o].T[None])
            grads.append(gk)
        grads += [gh.sum(0), gout]
        self.step += 1
        for q, gr, (m, v) in zip(self.dense, grads, self.moments, strict=True):
            m += 0.1 * (gr - m)
            v += 0.001 * (gr * gr - v)
            q -= params.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)
        gw = gx[index]
        hit = np.flatnonzero(gw.any(axis=1))
        for rows in (a[hit], b[hit]):
            each, back = np.unique(rows, return_inverse=True)
            gr = np.zeros((len(each), params.dim), np.float32)
            np.add.at(gr, back, gw[hit])
            self.second[each] += (gr * gr).mean(axis=1)
            self.hits[each] += 1
            model.table[each] -= 10 * params.rate * gr / (np.sqrt(self.second[each])[:, None] + 1e-8)


def train(hashes: np.ndarray, counts: np.ndarray, toxic: list[int], params: Params = Params()) -> Model:
    """One learner over documents at hand."""
    rng = np.random.default_rng(params.seed)
    y = np.asarray(toxic, np.float32)
    model = blank(params, rng)
    at = np.concatenate([[0], np.cumsum(counts)])
    rows_a, rows_b = model.rows(hashes)
    one, all_ = np.sum([seen(rows, counts, y, len(model.table)) for rows in (rows_a, rows_b)], axis=0)
    if primed(model, one, all_, y.sum(), len(y)).constant is not None:
        return model
    learner = Learner(model)
    for _ in range(params.epochs):
        order = rng.permutation(len(y))
        for s in range(0, len(y), params.batch):
            own = order[s : s + params.batch]
            words = np.concatenate([np.arange(at[i], at[i + 1]) for i in own])
            learner.learn(rows_a[words], rows_b[words], counts[own], y[own])
    return model


def scaled(model: Model, scores: np.ndarray, toxic: list[int], times: np.ndarray | None = None) -> tuple[float, float]:
    """Platt's scaling: a logistic regression of the labels on the model's logits, by Newton's method, with his targets,
    so that 0.5 is the even chance on rows that the filters have not seen. Each entry stands for `times` rows."""
    y = np.asarray(toxic, np.float64)
    if model.constant is not None or not len(y) or y.min() == y.max():
        return model.scale
    times = np.ones(len(y)) if times is None else times
    n1, n = (y * times).sum(), times.sum()
    s = np.clip(scores, 1e-12, 1 - 1e-12)
    x = np.stack([np.log(s / (1 - s)), np.ones(len(s))], 1)
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n - n1 + 2))
    w = np.array([0.5, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (times * (p * (1 - p) + 1e-9))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (times * (p - t)))
        w -= np.clip(step, -1, 1)
    return (float(max(w[0], 1e-3)), float(w[1]))


def calibrate(scores: np.ndarray, toxic: np.ndarray, langs: list[str | None], least: int = 30, times: np.ndarray | None = None) -> dict[str, float]:
    """For each language with toxic and clean labels, the threshold with the best F1, half-way between scores, nearest to 0.5
    if several are best, and that of all languages (at ''), weighted by the labels of the rarer kind and by `least`: a
    language with few labels stays close to that of all. Each entry stands for `times` rows."""
    def best(s, y, n):
        if not len(s) or y.min() == y.max():
            return 0.5
        order = np.argsort(-s, kind="stable")
        s, y, n = s[order], y[order], n[order]
        hits = np.cumsum(y * n)
        f1 = 2 * hits / (np.cumsum(n) + hits[-1])
        last = np.append(s[1:] < s[:-1], True)
        cut = np.append((s[1:] + s[:-1]) / 2, s[-1] / 2)
        f1 = np.where(last, f1, -1)
        good = cut[f1 >= f1.max() - 1e-12]
        return float(good[np.abs(good - 0.5).argmin()])

    toxic, names = np.asarray(toxic), np.array([x or "" for x in langs], object)
    times = np.ones(len(toxic), np.int64) if times is None else times
    found = {"": best(scores, toxic, times)}
    for name in set(names) - {""}:
        own = names == name
        n = int(min((toxic * times)[own].sum(), ((1 - toxic) * times)[own].sum()))
        if n:
            found[name] = (n * best(scores[own], toxic[own], times[own]) + least * found[""]) / (n + least)
    return found


def _fifth(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(5))


def held_out(doc_id: Column) -> Column:
    return _fifth(doc_id) == 0


def usable(labels: DataFrame) -> DataFrame:
    """doc_id, toxic: the labels that may be learned from."""
    good = F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    return labels.where(good).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def fitting(sizes: list[int], most: int) -> list[int]:
    """Places of the sizes that fit `most` together, taken in order."""
    kept, held = [], 0
    for i, n in enumerate(sizes):
        if held + n <= most:
            kept.append(i)
            held += n
    return kept


def sample(docs: DataFrame, labels: DataFrame, params: Params) -> list:
    """Rows of doc_id, toxic, lang, words (hashes, as bytes), in the order of doc_id: `rows` labelled documents as far as they
    fit `words` words together, for a look at them on the driver. `fit` has no part in this."""
    ids = usable(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.rows)
    mine = docs.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id")  # params.rows ids at most
    once = mine.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), "lang")).alias("d")).select("doc_id", "toxic", "d.lang", "d.text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, sizes = [], []
            for text in b.column("text").to_pylist():
                hashes, counts = hash_words([text])
                data.append(hashes.tobytes())
                sizes.append(int(counts[0]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic").cast(pa.int64()), b.column("lang"), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())], names=["doc_id", "toxic", "lang", "n", "words"])

    made = materialise(once.select("doc_id", "toxic", "lang", "text").mapInArrow(run, "doc_id bigint, toxic bigint, lang string, n bigint, words binary"), "sample")
    sizes = made.select("doc_id", "n").orderBy(F.xxhash64("doc_id"), "doc_id").collect()  # params.rows rows at most
    kept = [sizes[i].doc_id for i in fitting([r.n for r in sizes], params.words)]
    if not kept:
        return []
    chosen = docs.sparkSession.createDataFrame([(k,) for k in kept], "doc_id bigint")
    return sorted(made.join(F.broadcast(chosen), "doc_id").collect(), key=lambda r: r.doc_id)  # params.rows rows, params.words words at most


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """toxic, lang, late (whether it is left to scale and thresholds), text: every labelled document that is not held out."""
    mine = docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang").join(usable(labels), "doc_id")
    once = mine.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), "lang")).alias("d"))
    late = (_fifth(F.col("doc_id")) == 1).alias("late")
    return materialise(once.select(F.col("toxic").cast("long").alias("toxic"), "d.lang", late, "d.text"), "labelled")


def _portions(texts: list[str], order: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Places in order, `most` texts at a time and about `BLOCK` code points."""
    i = 0
    while i < len(order):
        j, held = i, 0
        while j < len(order) and j - i < most and (j == i or held + len(texts[order[j]]) <= BLOCK):
            held += len(texts[order[j]])
            j += 1
        yield order[i:j]
        i = j


def counted(rows: DataFrame, params: Params) -> tuple[np.ndarray, np.ndarray, int, int, int]:
    """For each row of the table the toxic documents that have it, and all; toxic documents, all documents, words."""
    size, shape = 2 * params.buckets, Model(params, None, [], None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, all_ = np.zeros(size + 2, np.int64), np.zeros(size + 2, np.int64)
        for b in batches:
            texts, toxic = b.column("text").to_pylist(), b.column("toxic").to_numpy()
            for own in _portions(texts, np.arange(len(texts)), len(texts)):
                hashes, counts = hash_words([texts[i] for i in own])
                for each in shape.rows(hashes):
                    x, n = seen(each, counts, toxic[own], size)
                    one[:size] += x.astype(np.int64)
                    all_[:size] += n
                one[size] += toxic[own].sum()
                all_[size:] += len(own), len(hashes)
        at = np.flatnonzero(all_)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, one[at], all_[at])], names=["row", "one", "n"])

    found = rows.select("toxic", "text").mapInArrow(run, "row bigint, one bigint, n bigint").groupBy("row").agg(F.sum("one").alias("one"), F.sum("n").alias("n")).toArrow()  # a row for each of the table's at most
    one, all_ = np.zeros(size + 2, np.int64), np.zeros(size + 2, np.int64)
    at = found.column("row").to_numpy()
    one[at], all_[at] = found.column("one").to_numpy(), found.column("n").to_numpy()
    return one[:size], all_[:size], int(one[size]), int(all_[size]), int(all_[size + 1])


def _flat(model: Model) -> np.ndarray:
    """All dense weights, as rows of the table's width."""
    x = np.concatenate([w.ravel() for w in (*model.kernels, model.bias, model.out)])
    return np.pad(x, (0, -len(x) % model.params.dim)).reshape(-1, model.params.dim)


def _move(model: Model, by: np.ndarray) -> None:
    at, by = 0, by.ravel()
    for w in (*model.kernels, model.bias, model.out):
        w += by[at : at + w.size].reshape(w.shape)
        at += w.size


def descend(rows: DataFrame, model: Model, turn: int) -> None:
    """Each task's learner goes over its rows once, from the model; the model goes where they go in the mean."""
    p, size = model.params, len(model.table)
    shared = rows.sparkSession.sparkContext.broadcast((vars(p), model.table, model.kernels, model.bias, model.out))
    names = [f"d{i}" for i in range(p.dim)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old = Model(Params(**shared.value[0]), *shared.value[1:])
        new = Model(old.params, old.table.copy(), [k.copy() for k in old.kernels], old.bias.copy(), old.out.copy())
        learner, rng, docs = Learner(new), np.random.default_rng([p.seed, turn]), 0
        for b in batches:
            texts, toxic = b.column("text").to_pylist(), b.column("toxic").to_numpy()
            for own in _portions(texts, rng.permutation(len(texts)), p.batch):
                learner.learn(*_rows_and_counts(new, [texts[i] for i in own]), toxic[own].astype(np.float32))
                docs += len(own)
        if docs:
            hit = np.flatnonzero(learner.hits)
            dense = _flat(new) - _flat(old)
            at = np.concatenate([hit, size + np.arange(len(dense))])
            times = np.concatenate([learner.hits[hit], np.full(len(dense), docs)])
            moved = np.concatenate([new.table[hit] - old.table[hit], dense]).astype(np.float64) * times[:, None]
            whole = np.rint(moved * UNIT).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(times), *[pa.array(np.ascontiguousarray(x)) for x in whole.T]], names=["row", "times", *names])

    made = rows.select("toxic", "text").mapInArrow(run, ", ".join(f"{x} bigint" for x in ("row", "times", *names)))
    found = made.groupBy("row").agg(*[F.sum(x).alias(x) for x in ("times", *names)]).toArrow()  # a row for each of the model's at most
    at, times = found.column("row").to_numpy(), found.column("times").to_numpy()
    moved = np.stack([found.column(x).to_numpy() for x in names], axis=1) / (UNIT * times[:, None])
    own = at < size
    model.table[at[own]] += moved[own].astype(np.float32)
    by = np.zeros_like(_flat(model))
    by[at[~own] - size] = moved[~own]
    _move(model, by)


def _rows_and_counts(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes, counts = hash_words(texts)
    return *model.rows(hashes), counts


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """Learns from labels.toxic of every labelled document that is not held out."""
    rows = labelled(docs, labels)
    early, late = rows.where("not late"), rows.where("late")
    one, all_, n1, n, words = counted(early, params)
    model = primed(blank(params, np.random.default_rng(params.seed)), one, all_, n1, n)
    if model.constant is None:
        learners = max(1, n // params.rows, words // params.words)
        for turn in range(params.epochs):
            descend(early.coalesce(learners), model, turn)
    s = F.greatest(F.least(F.col("score"), F.lit(1 - 1e-12)), F.lit(1e-12))
    logit = F.round(F.log(s / (1 - s)) * LOGIT).cast("long").alias("logit")
    # For each language and label, so many rows as there are logits at most.
    found = with_scores(late.select("toxic", "lang", "text"), model).groupBy("toxic", "lang", logit).agg(F.count("*").alias("times")).orderBy("toxic", "lang", "logit").toArrow()
    if len(found):
        toxic, times = found.column("toxic").to_numpy(), found.column("times").to_numpy()
        z = found.column("logit").to_numpy() / LOGIT
        model.scale = scaled(model, 1 / (1 + np.exp(-z)), toxic, times)
        model.thresholds = calibrate(1 / (1 + np.exp(-(model.scale[0] * z + model.scale[1]))), toxic, found.column("lang").to_pylist(), times=times)
    return model


def with_scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs and a score, each text whole."""
    docs = docs.drop(name)
    spark = docs.sparkSession
    p = model.params
    shared = spark.sparkContext.broadcast((vars(p), model.table, model.kernels, model.bias, model.out, model.constant, model.scale))
    kinds = docs.schema.names

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(Params(**shared.value[0]), *shared.value[1:])
        for batch in batches:
            texts = batch.column("text").to_pylist()
            scores, i = [], 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size + len(texts[j] or "") <= BLOCK):
                    size += len(texts[j] or "")
                    j += 1
                scores.append(own.score(texts[i:j]))
                i = j
            found = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in kinds], pa.array(found, pa.float64())], names=[*kinds, name])

    from pyspark.sql import types as T

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def threshold(model: Model, lang: str = "lang") -> Column:
    """The calibrated threshold of a row's language."""
    rest = F.lit(model.thresholds.get("", 0.5))
    known = {k: v for k, v in model.thresholds.items() if k}
    if not known:
        return rest
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.coalesce(F.col(lang), F.lit(""))), rest)


def scored_documents(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """doc_id, held_out, score, predicted (0.5), flagged (score at its language's threshold or above)."""
    model = fit(docs, labels, params)
    s = with_scores(docs.select("doc_id", "lang", "text"), model)
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), (F.col("score") >= threshold(model)).alias("flagged"))
