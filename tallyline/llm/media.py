"""Interleaved document sequences and the media that they refer to.

``sequences`` parses HTML into an ordered array of text and media-reference structs. ``media_table``
keeps each distinct payload once, by digest, as an 8-bit greyscale PNG. ``describe`` reads the stored
bytes back and computes features. ``resolve`` joins references with media by digest; a reference keeps
its position and caption. Payloads are shuffled once, compressed, and never replicated: features are
computed per distinct payload, so only small rows meet the references of a popular digest.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import pieces

#: Samples of a stored row; payloads are padded to a positive multiple with PAD.
ROW = 576
PAD = 255
PNG_HEAD = b"\x89PNG\r\n\x1a\n"
SEGMENT = "struct<pos:int,kind:string,text:string,digest:string,caption:string>"
REFERENCE = "sha256:"


def padded(raw: Column) -> Column:
    """Bytes with PAD appended up to a positive multiple of ROW; null counts as empty."""
    raw = F.coalesce(raw, F.lit(b""))
    size = F.octet_length(raw)
    missing = F.greatest(F.ceil(size / F.lit(ROW)), F.lit(1)).cast("int") * ROW - size
    return F.concat(raw, F.unhex(F.repeat(F.lit(f"{PAD:02X}"), missing)))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes) -> bytes:
    """A lossless 8-bit greyscale PNG, ROW samples wide; the payload's length is a multiple of ROW."""
    rows = len(payload) // ROW
    lines = np.zeros((rows, ROW + 1), dtype=np.uint8)  # each line begins with its filter, none
    lines[:, 1:] = np.frombuffer(payload, dtype=np.uint8).reshape(rows, ROW)
    head = struct.pack(">IIBBBBB", ROW, rows, 8, 0, 0, 0, 0)
    return PNG_HEAD + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + _chunk(b"IEND", b"")


def from_png(media: bytes) -> np.ndarray:
    """Samples of a PNG that ``to_png`` wrote, by line; checksums are verified."""
    if media[:8] != PNG_HEAD:
        raise ValueError("not a PNG")
    at, body, width, height = 8, [], 0, 0
    while at < len(media):
        (size,) = struct.unpack_from(">I", media, at)
        kind, data = media[at + 4 : at + 8], media[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", media, at + 8 + size)[0] != zlib.crc32(kind + data):
            raise ValueError("broken PNG chunk")
        if kind == b"IHDR":
            width, height, *form = struct.unpack(">IIBBBBB", data)
            if form != [8, 0, 0, 0, 0]:
                raise ValueError("not an 8-bit greyscale PNG")
        elif kind == b"IDAT":
            body.append(data)
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(body)), dtype=np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("filtered lines")
    return lines[:, 1:]


def feature(samples: np.ndarray) -> str:
    """Height, mean, deviation and the shares of four ranges of the samples, as text."""
    flat = samples.reshape(-1)
    shares = np.bincount(flat >> 6, minlength=4) / flat.size
    figures = [flat.mean(dtype=np.float64), flat.std(dtype=np.float64), *shares]
    return f"{samples.shape[1]}x{samples.shape[0]};" + ";".join(f"{x:.6f}" for x in figures)


class _Segments(HTMLParser):
    """Collects text runs and media references in document order."""

    BREAKS = {"p", "div", "li", "br", "figure", "section", "article", "h1", "h2", "h3", "h4", "td", "tr", "table"}
    MEDIA = {"img", "video", "audio", "source"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[dict] = []
        self.run: list[str] = []
        self.hidden = 0
        self.figures: list[tuple[list[dict], list[dict]]] = []  # media and captions of the open figures
        self.caption: list[str] | None = None

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        self.run = []
        if text:
            self.found.append({"kind": "text", "text": text, "digest": None, "caption": None})

    def end_caption(self) -> None:
        """The caption so far becomes a text, until its figure has media."""
        text, self.caption = " ".join("".join(self.caption or ()).split()), None
        if text:
            self.found.append({"kind": "text", "text": text, "digest": None, "caption": None})
            if self.figures:
                self.figures[-1][1].append(self.found[-1])

    def end_figure(self) -> None:
        self.end_caption()
        media, captions = self.figures.pop()
        if media and captions:
            for item in media:
                item["caption"] = " ".join(c["text"] for c in captions)
            for caption in captions:
                caption["kind"] = None  # no segment of its own

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.hidden += 1
        elif tag in self.MEDIA:
            self.flush()
            values = dict(attrs)
            source = values.get("src") or ""
            digest = source.removeprefix(REFERENCE).lower() if source.startswith(REFERENCE) else hashlib.sha256(source.encode()).hexdigest()
            item = {"kind": "media", "text": source, "digest": digest, "caption": values.get("alt") or None}
            self.found.append(item)
            if self.figures:
                self.figures[-1][0].append(item)
        elif tag == "figcaption":
            self.flush()
            self.end_caption()
            self.caption = []
        elif tag in self.BREAKS:
            self.flush()
            if tag == "figure":
                self.end_caption()
                self.figures.append(([], []))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        elif tag == "figcaption" and self.caption is not None:
            self.end_caption()
        elif tag in self.BREAKS:
            self.flush()
            if tag == "figure" and self.figures:
                self.end_figure()

    def handle_data(self, data):
        if not self.hidden:
            (self.run if self.caption is None else self.caption).append(data)

    def segments(self, html: str) -> list[dict]:
        self.feed(html)
        self.close()
        self.flush()
        self.end_caption()
        while self.figures:
            self.end_figure()
        return [{"pos": i} | item for i, item in enumerate(x for x in self.found if x["kind"])]


def sequences(df: DataFrame, key: str, html: str) -> DataFrame:
    """``key`` and ``segments``: the ordered text and media references of each row's HTML.

    Null or empty HTML gives an empty array. Repeated rows and null keys stay. Other columns are not
    returned. A figure's captions go to each of its media, else ``alt`` does; a caption without media
    is a text. An open caption ends with its figure or the input.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = pa.list_(pa.struct([("pos", pa.int32()), *((n, pa.string()) for n in ("kind", "text", "digest", "caption"))]))
        for batch in batches:
            for part in pieces(batch, "html"):
                out = [_Segments().segments(x) if x else [] for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(out, form)], names=[key, "segments"])

    return df.select(F.col(key).alias("key"), F.col(html).alias("html")).mapInArrow(run, f"`{key}` {kind}, segments array<{SEGMENT}>")


def media_table(df: DataFrame, payload: str) -> DataFrame:
    """Each distinct payload once: ``digest`` (of the payload) and ``media``, its PNG.

    Payloads are binary, their length a positive multiple of ROW. They are compressed before the one
    shuffle that removes repeats.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "payload"):
                seen = {}
                for value in part.column("payload").to_pylist():
                    if (digest := hashlib.sha256(value).hexdigest()) not in seen:
                        seen[digest] = to_png(value)
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.binary())], names=["digest", "media"])

    return df.select(F.col(payload).alias("payload")).where("payload is not null").mapInArrow(run, "digest string, media binary").dropDuplicates(["digest"])


def describe(media: DataFrame) -> DataFrame:
    """Figures of each stored medium, from the samples read back out of its bytes."""
    schema = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "media"):
                rows = []
                for digest, stored in zip(part.column("digest").to_pylist(), part.column("media").to_pylist()):
                    samples = from_png(stored)
                    payload = samples.tobytes()
                    rows.append((digest, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(samples)))
                names = ["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return media.select("digest", "media").mapInArrow(run, schema)


def references(sequence: DataFrame, key: str) -> DataFrame:
    """One row for each media reference: ``key``, ``pos``, ``digest``, ``caption``."""
    item = sequence.select(key, F.explode("segments").alias("s")).where("s.kind = 'media'")
    return item.select(key, "s.pos", "s.digest", "s.caption")


def resolve(refs: DataFrame, media: DataFrame) -> DataFrame:
    """References joined with media by digest; those without a medium stay, with nulls.

    Both sides are dealt anew by a key of the digest so that Spark can split a popular digest.
    """
    left = refs.withColumn("join_digest", F.concat("digest", F.lit("")))
    right = media.withColumn("join_digest", F.concat("digest", F.lit(""))).drop("digest")
    return left.join(right.hint("merge"), "join_digest", "left").drop("join_digest")
