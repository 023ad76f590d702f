"""Media columns: Aho-Corasick signature sniffing with format validators, and a lossless 8-bit audio container for bytes."""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from visitgraph.llm.common import private

#: Magic bytes by type.
MAGIC = {
    "wav": b"RIFF",
    "png": b"\x89PNG\r\n\x1a\n",
    "gif87": b"GIF87a",
    "gif89": b"GIF89a",
    "jpeg": b"\xff\xd8\xff",
    "bmp": b"BM",
    "pdf": b"%PDF-",
    "zip": b"PK\x03\x04",
    "gzip": b"\x1f\x8b\x08",
}
FOUND = "array<struct<type:string,start:long,length:long,body:long,body_length:long>>"


def _wav(b: bytes, at: int):
    if len(b) < at + 12 or b[at + 8 : at + 12] != b"WAVE":
        return None
    end, p, body, fmt = at + 8 + struct.unpack_from("<I", b, at + 4)[0], at + 12, None, None
    if end > len(b):
        return None
    while p + 8 <= end:
        name, n = b[p : p + 4], struct.unpack_from("<I", b, p + 4)[0]
        if p + 8 + n > end:
            return None
        if name == b"fmt " and n >= 16:
            fmt = struct.unpack_from("<HHIIHH", b, p + 8)
        if name == b"data":
            body = (p + 8, n)
        p += 8 + n + (n & 1)
    return (end - at, *body) if body and fmt and fmt[3] == fmt[2] * fmt[4] and fmt[4] == fmt[1] * fmt[5] // 8 else None


def _png(b: bytes, at: int):
    p, first = at + 8, None
    while p + 12 <= len(b):
        n, name = struct.unpack_from(">I4s", b, p)
        if p + 12 + n > len(b) or zlib.crc32(b[p + 4 : p + 8 + n]) != struct.unpack_from(">I", b, p + 8 + n)[0]:
            return None
        first = first or (name, p + 8, n)
        p += 12 + n
        if name == b"IEND":
            return (p - at, first[1], p - first[1]) if first[0] == b"IHDR" and first[2] == 13 else None
    return None


def _gif(b: bytes, at: int):
    if len(b) < at + 13:
        return None
    flags = b[at + 10]
    p = at + 13 + (3 << ((flags & 7) + 1) if flags & 128 else 0)
    body = p
    while p < len(b):
        if b[p] == 0x3B:
            return p + 1 - at, body, p - body
        if b[p] == 0x2C:
            if p + 10 > len(b):
                return None
            p += 10 + (3 << ((b[p + 9] & 7) + 1) if b[p + 9] & 128 else 0) + 1
        elif b[p] == 0x21:
            p += 2
        else:
            return None
        while p < len(b) and b[p]:
            p += b[p] + 1
        p += 1
    return None


def _after(marks: list[int], at: int) -> int:
    """The first of sorted ``marks`` from ``at`` on, -1 without one."""
    i = bisect.bisect_left(marks, at)
    return marks[i] if i < len(marks) else -1


def _jpeg(b: bytes, at: int, ends: list[int]):
    p = at + 2
    while p + 4 <= len(b) and b[p] == 0xFF:
        if b[p + 1] == 0xDA:
            end = _after(ends, p)
            return (end + 2 - at, p, end - p) if end > 0 else None
        p += 2 + max(2, struct.unpack_from(">H", b, p + 2)[0])
    return None


def _bmp(b: bytes, at: int):
    if len(b) < at + 54:
        return None
    size, zero, start, head, width, height, planes, bits = struct.unpack_from("<IIIIiiHH", b, at + 2)
    row = (abs(width) * bits + 31) // 32 * 4
    fits = zero == 0 and head in (40, 108, 124) and planes == 1 and bits in (1, 4, 8, 16, 24, 32)
    return (size, at + start, size - start) if fits and at + size <= len(b) and start + row * abs(height) == size else None


def _pdf(b: bytes, at: int, ends: list[int]):
    end = _after(ends, at)
    return (end + 5 - at, at, end + 5 - at) if end > 0 and b[at + 5 : at + 6].isdigit() else None


def _zip(b: bytes, at: int, ends: list[int]):
    end = _after(ends, at)
    return (end + 22 - at, at, end - at) if 0 < end <= len(b) - 22 else None


def _gzip(b: bytes, at: int):
    d = zlib.decompressobj(31)
    try:
        view = memoryview(b)[at:]
        for i in range(0, len(view), 65536):
            d.decompress(view[i : i + 65536])
            if d.eof:
                n = min(i + 65536, len(view)) - len(d.unused_data)
                return n, at + 10, n - 18
    except zlib.error:
        pass
    return None


CHECKS = {"wav": _wav, "png": _png, "gif87": _gif, "gif89": _gif, "jpeg": _jpeg, "bmp": _bmp, "pdf": _pdf, "zip": _zip, "gzip": _gzip}
#: What ends a medium whose header has no length; the same search finds these.
ENDS = {"jpeg": b"\xff\xd9", "pdf": b"%%EOF", "zip": b"PK\x05\x06"}
NAMES = {"gif87": "gif", "gif89": "gif"}


def automaton(magic: dict[str, bytes] = MAGIC) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, m in magic.items():
        a.add_word(m.decode("latin-1"), (kind, len(m), False))
    for kind, m in ENDS.items():
        a.add_word(m.decode("latin-1"), (kind, len(m), True))
    a.make_automaton()
    return a


def sniff(blob: bytes | None, a: ahocorasick.Automaton) -> list[tuple]:
    """(type, start, length, body, body_length) of every signature in ``blob`` whose structure and lengths hold.

    Media inside media is listed too (its start lies within the outer one), so it can be carved.
    """
    found, ends = [], {kind: [] for kind in ENDS}
    for last, (kind, n, end) in a.iter((blob or b"").decode("latin-1")):
        ends[kind].append(last - n + 1) if end else found.append((kind, last - n + 1))
    out = []
    for kind, at in found:
        hit = CHECKS[kind](blob, at, ends[kind]) if kind in ENDS else CHECKS[kind](blob, at)
        if hit:
            out.append((NAMES.get(kind, kind), at, *hit))
    return sorted(out)


def sniff_media(df: DataFrame, blob_col: str, declared_col: str | None = None) -> DataFrame:
    """``df`` with ``media`` (array of struct(type, start, length, body, body_length), offsets in bytes from 0) and
    ``type``: the type of the medium that begins the blob. Where none does, what ``declared_col`` declares stays only if
    it is a type that ``MAGIC`` can't tell; a declaration that the bytes contradict becomes null.

    Columns of these names are replaced. Null and empty blobs hold nothing. Row by row, Arrow batches in, no shuffle.
    """

    @F.pandas_udf(FOUND)
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        a = automaton()
        for part in parts:
            yield pd.Series([[dict(zip(("type", "start", "length", "body", "body_length"), x, strict=True)) for x in sniff(b, a)] for b in part])

    out = df.withColumn("media", found(F.col(blob_col)))
    first = F.try_element_at(F.filter("media", lambda x: x["start"] == 0), F.lit(1))["type"]
    known = [NAMES.get(k, k) for k in MAGIC]
    said = F.when(~F.lower(F.col(declared_col)).isin(known), F.col(declared_col)) if declared_col else F.lit(None).cast("string")
    return out.withColumn("type", F.coalesce(first, said))


def carve(df: DataFrame, blob_col: str) -> DataFrame:
    """One row per embedded medium of a sniffed table: the columns of ``df`` but ``media``, with type, start and ``carved``
    bytes (columns of these names are replaced)."""
    (one,) = private(df, "one")
    x = F.col(one)
    d = df.withColumn(one, F.explode(F.filter("media", lambda m: m["start"] > 0)))
    return d.withColumns({"carved": F.substring(F.col(blob_col), x["start"].cast("int") + 1, x["length"].cast("int")), "type": x["type"], "start": x["start"]}).drop(one, "media")


@F.pandas_udf(StringType())
def byte_profile(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """What bytes say of a medium: mean, entropy in bits, mean step between neighbours, and the shares of 16 equal ranges in thousandths."""

    def one(b: bytes) -> str:
        x = np.frombuffer(b or b"\0", np.uint8)
        share = np.bincount(x, minlength=256) / x.size
        p = share[share > 0]
        step = np.abs(np.diff(x.astype(np.int16))).mean() if x.size > 1 else 0.0
        return f"{x.mean():.3f},{-(p * np.log2(p)).sum() + 0.0:.3f},{step:.3f}," + ".".join(map(str, np.rint(share.reshape(16, 16).sum(axis=1) * 1000).astype(int)))

    for part in parts:
        yield part.map(one)


def little(n: Column, size: int) -> Column:
    """A whole number as ``size`` little-endian bytes."""
    return F.unhex(F.array_join(F.reverse(F.split(F.regexp_replace(F.lpad(F.hex(n.cast("long")), size * 2, "0"), "(..)(?!$)", "$1,"), ",")), ""))


def wav_of(payload: Column, rate: int = 8000) -> Column:
    """Bytes as an 8-bit mono sound file: one sample a byte, nothing lost."""
    n, num = F.octet_length(payload), lambda v, size: little(F.lit(v), size)
    fmt = F.concat(F.encode(F.lit("fmt "), "utf-8"), num(16, 4), num(1, 2), num(1, 2), num(rate, 4), num(rate, 4), num(1, 2), num(8, 2))
    return F.concat(F.encode(F.lit("RIFF"), "utf-8"), little(n + 36, 4), F.encode(F.lit("WAVE"), "utf-8"), fmt, F.encode(F.lit("data"), "utf-8"), little(n, 4), payload)


def store_texts(docs: DataFrame, text_col: str = "text", block: int = 576) -> DataFrame:
    """``docs`` with n_bytes and ``blob``: each whole text (null: empty) as UTF-8, padded with bytes 255 to a positive
    multiple of ``block``, as a sound file. Columns of these names are replaced."""
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8")
    n = F.octet_length(raw)
    pad = F.greatest(F.ceil(n / block), F.lit(1)) * block - n
    return docs.withColumn("n_bytes", n.cast("long")).withColumn("blob", wav_of(F.concat(raw, F.unhex(F.repeat(F.lit("FF"), pad.cast("int"))))))


def op8_media(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    d = sniff_media(store_texts(docs).select("doc_id", "n_bytes", "blob"), "blob")
    whole = F.element_at(F.filter("media", lambda x: (x["start"] == 0) & (x["type"] == "wav")), 1)
    d = d.withColumn("payload", F.substring("blob", (whole["body"] + 1).cast("int"), whole["body_length"].cast("int")))
    size = F.octet_length("payload")
    inner = F.transform(F.filter("media", lambda x: x["start"] > 0), lambda x: F.concat_ws(":", x["type"], x["start"], x["length"]))
    digest = F.sha2("payload", 256)
    return d.select("doc_id", "n_bytes", size.cast("long").alias("payload_bytes"), digest.alias("payload_sha256"), F.crc32(F.substring(F.col("payload"), F.greatest(size - 31, F.lit(1)), F.lit(32))).alias("tail_crc32"), F.octet_length("blob").cast("long").alias("media_bytes"), F.sha2("blob", 256).alias("media_sha256"), F.concat_ws(";", F.concat_ws(":", "type", F.lit("0"), whole["length"]), F.array_join(inner, ";"), byte_profile("payload")).alias("feature"))
