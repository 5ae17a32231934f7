"""Media columns: interleaved document sequences.

HTML is parsed into one ordered sequence of text runs and media references; a reference names its payload by digest and
keeps its caption. A digest join brings the payloads in. Each element keeps its position, so that text, captions and
payloads stay aligned whatever order a join returns.

Stored form of a payload: a binary PPM image (P6), 64 pixels wide, of 8-bit samples, lossless.

Nulls: null HTML gives an empty sequence; a reference whose digest the store lacks keeps a null payload; a null text has
an empty payload before padding. Repeated rows are each returned. Stored rows with equal digests count once.
"""

from __future__ import annotations

import hashlib
import html.parser
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = 192
WIDTH = ROW // 3
SEQUENCE = "array<struct<position:int,kind:string,text:string,digest:string,caption:string>>"
_SKIP = {"script", "style", "template", "noscript"}
_BLOCK = {"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "br", "tr", "article", "section", "figure", "figcaption", "ul", "ol", "table", "blockquote"}
_VOID = {"img", "audio", "video", "source", "embed"}


class _Reader(html.parser.HTMLParser):
    """Text runs end at block tags and media. A figure's caption is its figcaption, wherever it stands in the figure, else
    each image's alt text. What is in `_SKIP` gives neither text nor media. A figcaption that is never closed ends with its
    figure, and a skipped element that is never closed ends with the next closing tag of a block around it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[dict] = []
        self.run: list[str] = []
        self.skip: list[str] = []
        self.figures: list[dict] = []
        self.inside = False

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        self.run = []
        if text:
            self.out.append({"position": len(self.out), "kind": "text", "text": text, "digest": None, "caption": None})

    def handle_starttag(self, tag, attrs):
        if tag in _SKIP:
            self.skip.append(tag)
        if self.skip:
            return
        if tag in _BLOCK or tag in _VOID:
            self.flush()
        if tag in _VOID:
            a = dict(attrs)
            src = a.get("src") or ""
            digest = src.removeprefix("sha256:") if src.startswith("sha256:") else hashlib.sha256(src.encode("utf-8", "surrogatepass")).hexdigest()
            ref = {"position": len(self.out), "kind": "media", "text": None, "digest": digest, "caption": a.get("alt")}
            self.out.append(ref)
            if self.figures:
                self.figures[-1]["media"].append(ref)
        elif tag == "figure":
            self.figures.append({"media": [], "caption": None})
        elif tag == "figcaption" and self.figures:
            self.inside, self.figures[-1]["caption"] = True, []

    def close_figure(self) -> None:
        figure, self.inside = self.figures.pop(), False
        if figure["caption"] is not None:
            text = " ".join("".join(figure["caption"]).split())
            for ref in figure["media"]:
                ref["caption"] = text
            if not figure["media"]:
                self.run.append(text)

    def handle_endtag(self, tag):
        if self.skip:
            if tag not in self.skip and tag not in _BLOCK:
                return
            own = tag in self.skip
            del self.skip[len(self.skip) - 1 - self.skip[::-1].index(tag) if own else 0 :]
            if own:
                return
        if tag == "figcaption":
            self.inside = False
        elif tag == "figure" and self.figures:
            self.close_figure()
        if tag in _BLOCK:
            self.flush()

    def handle_data(self, data):
        if not self.skip:
            (self.figures[-1]["caption"] if self.inside else self.run).append(data)

    def close(self) -> None:
        super().close()
        while self.figures:
            self.close_figure()
        self.flush()


def parse_html(text: str | None) -> list[dict]:
    reader = _Reader()
    reader.feed(text or "")
    reader.close()
    return reader.out


def sequences(html_column: Column) -> Column:
    """The interleaved sequence of an HTML column."""

    def each(column: pd.Series) -> pd.Series:
        return column.map(parse_html)

    return F.pandas_udf(each, SEQUENCE)(html_column)


def resolve(df: DataFrame, store: DataFrame, sequence: str = "sequence", unique: bool = False) -> DataFrame:
    """One row an element of the sequence, with the columns of df, position, kind, text, caption, digest and payload.
    store: digest, payload (of any type), reduced to one row a digest, map-side first. With unique, the store has one row a
    digest already; then both sides of the join are plain exchanges, and Spark can split a digest that many rows refer to."""
    keep = [c for c in df.columns if c not in (sequence, "position", "kind", "text", "caption", "digest", "payload")]
    each = df.select(*keep, F.explode(sequence).alias("e")).select(*keep, "e.position", "e.kind", "e.text", "e.caption", "e.digest")
    once = store.select("digest", "payload").where("digest is not null")
    return each.join(once if unique else once.dropDuplicates(["digest"]), "digest", "left")


def payload(text: Column) -> Column:
    """UTF-8, then bytes 32 up to a positive multiple of ROW."""
    t = F.coalesce(text, F.lit(""))
    n = F.octet_length(t)
    short = F.when(n == 0, ROW).otherwise(F.pmod(-n, F.lit(ROW)))
    return F.concat(F.encode(t, "UTF-8"), F.encode(F.repeat(F.lit(" "), short), "UTF-8"))


def to_ppm(samples: Column) -> Column:
    head = F.concat(F.lit(f"P6\n{WIDTH} "), (F.octet_length(samples) / ROW).cast("long").cast("string"), F.lit("\n255\n"))
    return F.concat(F.encode(head, "UTF-8"), samples)


def from_ppm(stored: bytes) -> memoryview:
    """The samples, as stored; checks the header against their number."""
    magic, size, depth, at = b"", b"", b"", 0
    view = memoryview(stored)
    head = bytes(view[:64]).split(b"\n", 3)
    if len(head) == 4:
        magic, size, depth = head[:3]
        at = sum(map(len, head[:3])) + 3
    dims = size.split()
    if magic != b"P6" or depth != b"255" or len(dims) != 2 or int(dims[0]) * int(dims[1]) * 3 != len(view) - at:
        raise ValueError("not a whole PPM image")
    return view[at:]


def describe(stored: bytes) -> dict:
    """What is read back from a stored form. feature: rows, the mean of each channel, the mean step from row to row."""
    samples = from_ppm(stored)
    a = np.frombuffer(samples, np.uint8).reshape(-1, WIDTH, 3)
    mean = a.reshape(-1, 3).mean(axis=0)
    step = float(np.abs(np.diff(a.astype(np.int16), axis=0)).mean()) if len(a) > 1 else 0.0
    return {
        "payload_bytes": len(samples), "payload_sha256": hashlib.sha256(samples).hexdigest(), "tail_crc32": zlib.crc32(samples[-16:]),
        "media_bytes": len(stored), "media_sha256": hashlib.sha256(stored).hexdigest(), "feature": f"{len(a)}x{WIDTH} " + " ".join(f"{x:.3f}" for x in [*mean, step]),
    }


def described(store: DataFrame) -> DataFrame:
    """Reads every stored payload back, once a digest: digest, payload (struct of what describe() finds)."""
    names = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [describe(x.as_buffer()) for x in b.column("payload")]
            yield pa.RecordBatch.from_arrays([b.column("digest"), *[pa.array([r[k] for r in rows], t) for k, t in names.items()]], names=["digest", *names])

    once = store.select("digest", "payload").where("digest is not null and payload is not null").dropDuplicates(["digest"])
    kinds = "digest string, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    return once.mapInArrow(read, kinds).select("digest", F.struct(*names).alias("payload"))


def document_media(docs: DataFrame) -> DataFrame:
    """Every document as an interleaved page whose figure is the stored form of its text. The stored bytes are read back
    once a digest; the digest join brings what they hold to every reference, copies of one text included."""
    stored = to_ppm(payload(F.col("text")))
    store = docs.select(stored.alias("payload")).select(F.sha2("payload", 256).alias("digest"), "payload")
    refs = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), F.sha2(stored, 256).alias("digest"))
    page = F.concat(F.lit("<article><p>document</p><figure><img alt='' src='sha256:"), "digest", F.lit("'><figcaption>text of "), "n_bytes", F.lit(" bytes</figcaption></figure></article>"))
    found = resolve(refs.select("doc_id", "n_bytes", sequences(page).alias("sequence")), described(store), unique=True).where("kind = 'media'")
    return found.select("doc_id", "n_bytes", "payload.*", "position", "caption")
