"""Packing by order-preserving dynamic programming with monotone-queue transitions."""

from __future__ import annotations

import os
import re
import unicodedata
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = 1
#: What a cut costs, in tokens of padding: between documents nothing, after a sentence little, inside one more.
SENTENCE_CUT, WORD_CUT = 2.0, 12.0
PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: Bytes of texts whose words can be told apart without a look at their neighbours: letters up to U+01FF, digits, white
#: space, full stops and commas. Texts with anything else take the plain way.
_EASY = bytes(b for b in range(256) if chr(b).isascii() and (chr(b).isalnum() or chr(b) in " \t\n\r\v\f.,") or 0x80 <= b <= 0xBF or 0xC3 <= b <= 0xC7)
_HARD = (b"..", b",,", b".,", b",.", b"\xc3\x97", b"\xc3\xb7")


class Encoder:
    """Token ids of whole texts by a tokenizer file that treats white-space-separated words apart.

    Ids of a word are remembered (up to ``room`` words, then afresh), as most words of a corpus recur. Easy texts get
    their full stops and commas set apart first, which leaves more words equal; a word of letters alone needs no more
    than the model's merges.
    """

    def __init__(self, path: str, room: int = 1_200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.room, self.known = room, {}
        self.whole, self.letters = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.whole.encode_special_tokens = self.letters.encode_special_tokens = True
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def words(self, text: str) -> list[str]:
        raw = text.encode("utf-8", "surrogatepass")
        if not raw.translate(None, _EASY) and not any(x in raw for x in _HARD):
            return text.lower().replace(".", " . ").replace(",", " , ").split()
        return re.split(r"[\x20\t\n\r\x0b\x0c]+", text)

    def encode(self, text: str | None) -> np.ndarray:
        ws = self.words(text or "")
        parts = list(map(self.known.get, ws))
        if None in parts:
            new = {w for w, x in zip(ws, parts, strict=True) if x is None}
            if len(self.known) + len(new) > self.room:
                self.known.clear()
                new = set(ws)
            plain = [w for w in new if w.isalpha() and w == w.lower() and unicodedata.is_normalized("NFC", w)]
            for how, some in ((self.letters, plain), (self.whole, list(new.difference(plain)))):
                for w, e in zip(some, how.encode_batch(some, add_special_tokens=False), strict=True):
                    self.known[w] = np.array(e.ids, "<u4").tobytes()
            parts = list(map(self.known.get, ws))
        return np.frombuffer(b"".join(parts), "<u4")


def cuts(ends: np.ndarray, kinds: np.ndarray, size: int) -> list[int]:
    """Window ends over a stream, from candidate positions ``ends`` (ascending; the last is the stream's end).

    ``kinds`` is what a cut there costs. Windows hold at most ``size`` tokens; a window of n tokens is padded by
    size - n, or not at all where n is a power of two. cost[j] = min over i in reach of cost[i] + padding + kinds[j]:
    as padding is linear, the best i is the least of cost[i] + ends[i], kept at the head of a monotone queue, so each
    position enters and leaves once. Near the stream's end the powers of two are looked up besides. Consecutive candidates are at most
    ``size`` apart.
    """
    at = {0: 0}
    pos, cost, back = [0], [0.0], [-1]
    queue: deque[int] = deque([0])
    powers = [1 << k for k in range(size.bit_length()) if 1 << k < size]
    end = int(ends[-1])
    for j, (e, k) in enumerate(zip(ends.tolist(), kinds.tolist()), 1):
        while e - pos[queue[0]] > size:
            queue.popleft()
        i = queue[0]
        best = cost[i] + size - (e - pos[i])
        if end - e < size:
            for p in powers:
                x = at.get(e - p)
                if x is not None and cost[x] < best:
                    best, i = cost[x], x
        best += k
        pos.append(e)
        cost.append(best)
        back.append(i)
        at[e] = j
        key = best + e
        while queue and cost[queue[-1]] + pos[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    out, j = [], len(pos) - 1
    while j > 0:
        out.append(pos[j])
        j = back[j]
    return out[::-1]


def candidates(ids: list[np.ndarray], stops: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows may end: after documents and sentences, every 64 tokens in a stretch without either, and at the
    powers of two before the stream's end. ``stops`` tells which ids end a sentence."""
    flat = np.concatenate(ids)
    docs = np.cumsum([len(x) for x in ids])
    end = int(docs[-1])
    cost = np.full(end + 1, np.inf, np.float32)
    left = end % size
    while left:
        left &= left - 1
        cost[end - left] = WORD_CUT
    cost[1:][stops[flat]] = SENTENCE_CUT
    cost[docs] = 0.0
    own = np.concatenate(([0], np.flatnonzero(cost[1:] <= SENTENCE_CUT) + 1))
    for g in np.flatnonzero(np.diff(own) > 64):
        cost[own[g] + 64 : own[g + 1] : 64] = WORD_CUT
    every = np.flatnonzero(np.isfinite(cost[1:])) + 1
    return every, cost[every]


def pack_block(doc_ids: list, ids: list[np.ndarray], stops: np.ndarray, size: int, first_sequence: int) -> Iterator[tuple]:
    """Pieces of one block of documents, in order."""
    starts = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
    begin, d = 0, 0
    for n, end in enumerate(cuts(*candidates(ids, stops, size), size)):
        offset = 0
        while offset < end - begin:
            while starts[d + 1] <= begin + offset:
                d += 1
            start = begin + offset - int(starts[d])
            length = int(min(starts[d + 1], end)) - (begin + offset)
            yield doc_ids[d], start, length, ids[d][start : start + length].astype("<u4").tobytes(), len(ids[d]), first_sequence + n, offset
            offset += length
        begin = end


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = 1 << 20) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of all documents, packed in their order.

    ``ids`` are little-endian 32-bit token ids by the tokenizer file ``tokenizer``; every document ends in id 1, and a
    null or empty text is that id alone. Each input partition is read in its order, as blocks of about ``block_tokens``
    tokens (a longer document makes a longer block); no shuffle, and a task holds one block. A sequence id is the
    partition's number times 2^33 plus a count, so no two tasks share one. Windows end between documents or sentences
    where that costs less than padding, else between words; the stream's last windows may be powers of two, which need
    no padding. Null ids stay null; repeated rows are packed each; no rows give no rows.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encoder = _encoder(tokenizer)
        stops = np.zeros(encoder.whole.get_vocab_size(), bool)
        stops[[int(encoder.encode(s)[0]) for s in (".", "!", "?", "!!")]] = True
        sequence = TaskContext.get().partitionId() << 33
        names, ids, held = [], [], 0

        def flush() -> pd.DataFrame:
            nonlocal sequence, names, ids, held
            rows = list(pack_block(names, ids, stops, size, sequence))
            sequence = rows[-1][5] + 1
            names, ids, held = [], [], 0
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            return out

        for part in parts:
            for name, text in zip(part["doc_id"].astype("Int64"), part["text"], strict=True):
                x = np.append(encoder.encode(text), np.uint32(END))
                names.append(name)
                ids.append(x)
                held += len(x)
                if held >= block_tokens:
                    yield flush()
        if ids:
            yield flush()

    return d.mapInPandas(run, PIECE)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One encoder a Python worker, which serves task after task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_packing(spark, sf_dir):
    pieces = pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
