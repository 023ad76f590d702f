"""SentencePiece encoding that keeps every piece's place in the original text, and decoding."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
ENCODED = "ids array<int>, starts array<int>, ends array<int>"


class CharMap:
    """A compiled character map: a double-array trie over UTF-8 prefixes, and the strings that replace them.

    ``longest`` walks the trie as far as the bytes lead and gives the last replacement met.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.strings = blob[4 + size :]

    def longest(self, raw: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, bytes consumed) of the longest mapped prefix of ``raw[at:]``, if any."""
        units = self.units
        if not units:
            return None
        unit, node, found = units[0], 0, None
        node ^= (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(units) or units[node] & 0x800000FF != raw[i]:
                break
            unit = units[node]
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        start, used = found
        return self.strings[start : self.strings.index(b"\0", start)], used


class Normalizer:
    """Normalised text with each of its bytes' source: what ``normalizer_spec`` of a model says.

    Besides the character map: a mark for every space, one before the text, no runs of spaces where the model has none.
    """

    def __init__(self, charsmap: bytes, dummy_prefix: bool, squeeze: bool, escape: bool):
        self.map, self.dummy, self.squeeze = CharMap(charsmap), dummy_prefix, squeeze
        self.space = SPACE.encode() if escape else b" "
        self.plain = not charsmap and not squeeze

    def one(self, raw: bytes, at: int) -> tuple[bytes, int]:
        hit = self.map.longest(raw, at)
        if hit is not None:
            return hit
        lead = raw[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return raw[at : at + n], n

    def normalize(self, text: str) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, source offset of each and of the end)."""
        raw = text.encode()
        if not raw:
            return b"", np.zeros(1, np.int32)
        if self.plain:
            lead = len(self.space) if self.dummy else 0
            widths = np.where(np.frombuffer(raw, np.uint8) == 0x20, len(self.space), 1)
            source = np.concatenate((np.zeros(lead, np.int32), np.repeat(np.arange(len(raw), dtype=np.int32), widths), [len(raw)]))
            return (self.space if lead else b"") + raw.replace(b" ", self.space), source.astype(np.int32)
        at, out, source = 0, bytearray(), []
        if self.squeeze:
            while at < len(raw):
                new, used = self.one(raw, at)
                if new != b" ":
                    break
                at += used
            if at == len(raw):
                return b"", np.zeros(1, np.int32)
        if self.dummy:
            out += self.space
            source += [at] * len(self.space)
        after_space = self.squeeze
        while at < len(raw):
            new, used = self.one(raw, at)
            while after_space and new.startswith(b" "):
                new = new[1:]
            if new:
                put = new.replace(b" ", self.space)
                out += put
                source += [at] * len(put)
                after_space = new.endswith(b" ") and self.squeeze
            at += used
        while self.squeeze and out.endswith(self.space):
            at = source[len(out) - len(self.space)]
            del out[-len(self.space) :], source[len(out) :]
        return bytes(out), np.array([*source, at], np.int32)


class PieceEncoder:
    """Ids and source spans of whole texts by a SentencePiece model file.

    The library itself encodes normalised text, with the model's own normalisation switched off. A text with single
    spaces, under a model that maps no characters and has no piece across a space mark or a line end, falls into words
    that are encoded apart and remembered: up to ``room`` words, and as many from before, of which those still in use
    are kept. Any other text is encoded as a whole.
    """

    def __init__(self, path: str, room: int = 400_000):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        spec = proto.normalizer_spec
        if not proto.trainer_spec.byte_fallback or proto.trainer_spec.treat_whitespace_as_suffix or any(p.type == p.USER_DEFINED for p in proto.pieces):
            raise ValueError("only models with byte fallback, space marks in front and no user-defined pieces")
        self.normalizer = Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
        multi = [p.piece for p in proto.pieces if p.type == p.NORMAL and len(p.piece) > 1]
        apart = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in multi)
        self.by_words = apart and self.normalizer.plain and spec.add_dummy_prefix and spec.escape_whitespaces
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = b"", False, False, False
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.length = np.array([len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.marks = np.array([p.piece.count(SPACE) for p in proto.pieces], np.int64)
        byte = [int(p.piece[3:5], 16) if p.type == p.BYTE else -1 for p in proto.pieces]
        self.is_byte = np.array(byte) >= 0
        #: Bytes of the character that a byte piece begins; 0 for those that go on with one.
        self.leads = np.array([0 if b < 0 or 0x80 <= b < 0xC0 else 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4 for b in byte])
        self.room, self.known, self.before = room, {}, {}

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        """Normalised bytes of each piece; of a character in byte pieces, the last one has them all."""
        out = self.length[ids]
        byte = self.is_byte[ids]
        if byte.any():
            out[byte] = 0
            lead = np.flatnonzero(self.leads[ids])
            n = self.leads[ids[lead]]
            out[lead + n - 1] = n
        return out

    def learn(self, words: list[str]) -> None:
        """Remembers words' ids, each with the source bytes of its piece in the upper half."""
        parts = [w if w.startswith("\n") else SPACE + w for w in words]
        found = self.model.encode(parts, num_threads=1)
        ids = np.fromiter(chain.from_iterable(found), np.int64)
        both = (ids | (self.lengths(ids) - 2 * self.marks[ids]) << 32).astype("<i8").tobytes()
        at = 0
        for w, x in zip(words, found, strict=True):
            end = at + 8 * len(x)
            self.known[w] = both[at:end]
            at = end

    def words(self, text: str) -> list[str] | None:
        """The words that a text falls into; None where it is encoded as a whole."""
        spread = text.replace("\n", " \n")
        if not text or not self.by_words or SPACE in text or "  " in spread or spread[0] == " " or spread[-1] == " ":
            return None
        return spread.split(" ")

    def know(self, texts: list[list[str]]) -> None:
        """Remembers all words of some texts, those that are new by one call of the library, as each has its fixed price."""
        every = set(chain.from_iterable(texts))
        new = every.difference(self.known)
        if not new:
            return
        if len(self.known) + len(new) > self.room:
            self.known, self.before = {}, self.known
            new = every
        self.known |= {w: x for w in new if (x := self.before.get(w)) is not None}
        if new := [w for w in new if w not in self.known]:
            self.learn(new)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, end) of every piece; start and end are bytes of the original text, end exclusive."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``encode`` of each text."""
        texts = [t or "" for t in texts]
        words = [self.words(t) for t in texts]
        self.know([w for w in words if w is not None])
        return [self._whole(t) if w is None else self._joined(w) for t, w in zip(texts, words, strict=True)]

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw, source = self.normalizer.normalize(text)
        ids = np.array(self.model.encode(raw.decode()), np.int64)
        ends = np.cumsum(self.lengths(ids))
        return ids.astype(np.int32), source[np.concatenate(([0], ends[:-1]))] if len(ids) else ids.astype(np.int32), source[ends]

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        both = np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<i4").reshape(-1, 2)
        ends = np.cumsum(both[:, 1], dtype=np.int32) - 1  # the mark before the text stands for nothing
        return both[:, 0], np.concatenate((np.zeros(1, np.int32), ends[:-1])), ends

    def decode(self, ids: np.ndarray | None) -> str:
        return self.whole.decode(ids.tolist()) if ids is not None and len(ids) else ""

    def decode_all(self, ids: list[np.ndarray]) -> list[str]:
        """``decode`` of each, by one call of the library."""
        found = iter(self.whole.decode([x.tolist() for x in ids if len(x)], num_threads=1) if any(map(len, ids)) else ())
        return [next(found) if len(x) else "" for x in ids]


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    """One encoder a Python worker, which serves task after task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, flush: int = 1 << 18) -> DataFrame:
    """Rows (``id_col``, ids, starts, ends): each text's pieces by the SentencePiece model file ``model``.

    ``ids`` are what the library's encode gives without begin and end ids; ``starts`` and ``ends`` are the bytes of the
    original UTF-8 text that a piece stands for. A space mark stands for its space, the one put before the text for
    nothing; of a character that is spelled in byte pieces, the last has all bytes. With ``decoded`` there is a column
    of that name, what the library's decode makes of the ids (``decode_pieces`` does it for stored ids). Null and empty texts have no
    pieces; repeated rows come out each; null ids stay null; no rows give no rows; other columns go. No shuffle: a task
    holds the pieces of texts of about ``flush`` characters, or of one text where that is longer.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(model)
        for part in parts:
            texts, held, begun = part["text"].tolist(), 0, 0
            for i, text in enumerate(texts):
                held += len(text or "")
                if held >= flush or i + 1 == len(texts):
                    rows = encoder.encode_all(texts[begun : i + 1])
                    out = pd.DataFrame(rows, columns=["ids", "starts", "ends"])
                    if decoded:
                        out["decoded"] = encoder.decode_all([r[0] for r in rows])
                    out.insert(0, "name", part["name"].iloc[begun : i + 1].to_numpy())
                    yield out
                    held, begun = 0, i + 1

    d = docs.select(F.col(id_col).alias("name"), F.col(text_col).cast("string").alias("text"))
    schema = f"name {d.schema['name'].dataType.simpleString()}, {ENCODED}" + (", decoded string" if decoded else "")
    return d.mapInPandas(run, schema).withColumnRenamed("name", id_col)


def decode_pieces(ids: Column, model: str) -> Column:
    """The text that the library's decode makes of an array of ids; of a null or empty array, the empty text."""

    @F.pandas_udf("string")
    def decoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(model)
        for part in parts:
            yield pd.Series([encoder.decode(x) for x in part], dtype=object)

    return decoded(ids)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op13_pieces(spark, sf_dir):
    out = encode_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_path(), decoded=True)
    n_bytes = F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_bytes")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), n_bytes)
