"""Token-id files in Simple-8b, written by Spark in ascending id order.

A segment holds the ids of neighbouring documents: a header, the documents' ids
and lengths, the word offset of each block, then 64-bit words.  The upper four
bits of a word select how many ids of how many bits it packs; selector 0 is an
escape: the next word is one value of more than 60 bits.  Ids are packed in blocks
of BLOCK ids, each of which starts on a word, so blocks decode on their own, and
all words of a selector decode in one vector step.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

#: Fixed values of the format: ids in a word by selector (0: escape), 60 // n bits each.
COUNTS = (1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
MAGIC = b"S8B1"
BLOCK = 8192
SEGMENT_IDS = 4 << 20
_U = np.uint64


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    out = np.zeros(len(values), np.uint8)
    for b in range(64):
        more = values >> _U(b) != 0
        if not more.any():
            break
        out += more
    return out


def pack_block(values: np.ndarray) -> np.ndarray:
    """The words of one block of values."""
    n = len(values)
    if not n:
        return np.empty(0, _U)
    bits = np.concatenate([_bits(values), np.zeros(60, np.uint8)])
    top = int(bits.max())
    # the most ids a word of which any run fits; selectors of more ids are tried where enough ids are small
    sure = max((s for s in range(1, len(COUNTS)) if 60 // COUNTS[s] >= top), key=lambda s: COUNTS[s], default=0)
    best = np.full(n, sure, np.int8)  # 0: more than 60 bits
    for s in range(len(COUNTS) - 1, 0, -1):
        c = COUNTS[s]
        if sure and c <= COUNTS[sure]:
            continue
        small = bits <= 60 // c
        if np.count_nonzero(small[:n]) < min(c, n):
            continue
        wide = np.zeros(n + 61, np.int32)
        np.cumsum(~small, out=wide[1:])
        best[wide[c : c + n] == wide[:n]] = s
    nexts = (np.arange(n) + np.array(COUNTS)[best]).tolist()
    at, starts = 0, []
    while at < n:
        starts.append(at)
        at = nexts[at]
    starts = np.array(starts)
    chosen = best[starts]
    place = np.cumsum(1 + (chosen == 0)) - (1 + (chosen == 0))
    words = np.zeros(place[-1] + 1 + (chosen[-1] == 0), _U)
    padded = np.concatenate([values, np.zeros(60, _U)])
    for s in np.unique(chosen):
        own = starts[chosen == s]
        if s == 0:
            words[place[chosen == 0] + 1] = values[own]
            continue
        c, w = COUNTS[s], 60 // COUNTS[s]
        out = np.full(len(own), int(s) << 60, _U)
        for j in range(c):
            out |= padded[own + j] << _U(j * w)
        words[place[chosen == s]] = out
    return words


def unpack_words(words: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` values of the words of one block."""
    sel = (words >> _U(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)  # the words after escapes
    if (sel == 0).any():
        i = 0
        while i < len(words):
            if sel[i] == 0 and not raw[i]:
                raw[i + 1] = True
                i += 1
            i += 1
    head = ~raw
    counts = np.where(head, np.array([*COUNTS, 0])[sel], 0)
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()) if len(counts) else 0, _U)
    for s in np.unique(sel[head]) if len(words) else ():
        own = np.flatnonzero((sel == s) & head)
        if s == 0:
            out[starts[own]] = words[own + 1]
            continue
        c, w = COUNTS[s], 60 // COUNTS[s]
        out[starts[own][:, None] + np.arange(c)] = (words[own][:, None] >> (np.arange(c) * w).astype(_U)) & _U((1 << w) - 1)
    return out[:n]


def write_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    blocks = [pack_block(ids[i : i + BLOCK].astype(_U)) for i in range(0, len(ids), BLOCK)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    null = np.array([i is None for i in doc_ids], np.uint8)
    return b"".join([
        MAGIC, struct.pack("<IQI", len(doc_ids), len(ids), len(blocks)), null.tobytes(),
        np.array([i or 0 for i in doc_ids], "<i8").tobytes(), np.array(lengths, "<u8").tobytes(), offsets.tobytes(),
        *[b.astype("<u8").tobytes() for b in blocks]])


def read_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc ids, lengths, ids) of a segment."""
    if data[:4] != MAGIC:
        raise ValueError("not a Simple-8b segment")
    n_docs, n_ids, n_blocks = struct.unpack_from("<IQI", data, 4)
    at = 20
    null = np.frombuffer(data, np.uint8, n_docs, at)
    doc_ids = np.frombuffer(data, "<i8", n_docs, at := at + n_docs)
    lengths = np.frombuffer(data, "<u8", n_docs, at := at + 8 * n_docs)
    offsets = np.frombuffer(data, "<u8", n_blocks + 1, at := at + 8 * n_docs).astype(np.int64)
    words = np.frombuffer(data, "<u8", int(offsets[-1]), at + 8 * (n_blocks + 1)).astype(_U)
    blocks = [
        unpack_words(words[offsets[b] : offsets[b + 1]], min(BLOCK, n_ids - b * BLOCK)) for b in range(n_blocks)
    ]
    ids = np.concatenate(blocks).astype("<u4") if blocks else np.empty(0, "<u4")
    return [None if z else int(i) for z, i in zip(null, doc_ids, strict=True)], lengths, ids


_loaded: dict[str, tuple] = {}
#: Pieces of texts, and words of other scripts, whose ids a worker remembers, at most.
CACHED_PIECES = 600_000
#: Letters, numbers and white space below U+0130, in lower case, as the tokenizer's pattern parts them.
_LETTER, _NUMBER, _BLANK = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u012f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\\t-\\r \u0085\u00a0"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_BLANK}{_LETTER}{_NUMBER}]+")
#: Texts that need the tokenizer's own normaliser: other scripts, control characters, and what may be a special token.
_OTHER = re.compile("[\u0130-\U0010ffff\x00-\x08\x0e-\x1f\x7f]|<\\|")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte: itself if it prints, else the next one from U+0100."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return {b: chr(b) if b in prints else chr(next(rest)) for b in range(256)}


def word_encoder(path: str) -> Callable[[str], bytes]:
    """Text to ids (little-endian 32-bit), by the tokenizers library.

    The tokenizer's model sees one piece of its pattern at a time, so each distinct
    piece is encoded once, and a worker remembers its ids.  Texts below U+0130 are
    lower-cased and parted here, which gives what the tokenizer's normaliser and
    pattern do; words with any other character go through the whole tokenizer, which
    joins nothing across white space.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    if path not in _loaded:
        tok = Tokenizer.from_file(path)
        _loaded[path] = (tok, tok.model.tokenize, {}, {}, _byte_letters())
    tok, tokenize, known, words_known, letters = _loaded[path]

    def piece(p: str) -> bytes:
        return array("I", [t.id for t in tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(letters))]).tobytes()

    def plain(text: str) -> bytes:
        pieces = _PIECES.findall(text.lower())
        out = [known.get(p) for p in pieces]
        if None in out:
            new = {p for p, ids in zip(pieces, out, strict=True) if ids is None}
            if len(known) + len(new) > CACHED_PIECES:
                known.clear()
                new = set(pieces)
            known.update((p, piece(p)) for p in new)
            out = [known[p] for p in pieces]
        return b"".join(out)

    def word(w: str) -> bytes:
        if not _OTHER.search(w):
            return plain(w)
        ids = words_known.get(w)
        if ids is None:
            if len(words_known) > CACHED_PIECES:
                words_known.clear()
            ids = words_known[w] = np.array(tok.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
        return ids

    def encode(text: str) -> bytes:
        if not _OTHER.search(text):
            return plain(text)
        return b"".join([word(w.decode()) for w in text.encode().split()])

    return encode


def _write(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path)
        part, segment = TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        doc_ids, lengths, chunks, total = [], [], [], 0

        def flush() -> pa.RecordBatch:
            data = write_segment(doc_ids, lengths, np.frombuffer(b"".join(chunks), "<u4"))
            return pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([total], pa.int64()), pa.array([data], pa.binary())],
                names=["part", "segment", "n_ids", "data"])

        for b in batches:
            for i, t in zip(b["id"].to_pylist(), b["text"].to_pylist(), strict=True):
                raw = (encode(t) if t else b"") + end
                doc_ids.append(i)
                lengths.append(len(raw) // 4)
                chunks.append(raw)
                total += len(raw) // 4
                if total >= SEGMENT_IDS:
                    yield flush()
                    segment += 1
                    doc_ids, lengths, chunks, total = [], [], [], 0
        if doc_ids:
            yield flush()

    return run


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Segments (part, segment, n_ids, data) in ascending id order, stored in the shared folder.

    Null texts count as empty; null ids come first; rows that repeat an id follow in
    the order of their texts.  Other columns are ignored, whatever their names; an
    empty table gives no segments; a text of any length lies in one segment.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    n = C.n_tasks(docs)
    ordered = rows.repartitionByRange(n, "id").sortWithinPartitions("id", "text")
    return C.stored(ordered.mapInArrow(_write(tokenizer, end_id), "part int, segment int, n_ids long, data binary"), "none")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, segment, data in zip(b["part"].to_pylist(), b["segment"].to_pylist(), b["data"], strict=True):
            doc_ids, lengths, ids = read_segment(data.as_py())
            ends = np.cumsum(lengths.astype(np.int64))
            starts = ends - lengths.astype(np.int64)
            crc = [zlib.crc32(ids[a:z].tobytes()) for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]
            n = len(doc_ids)
            yield pa.record_batch(
                [pa.array([part] * n, pa.int32()), pa.array([segment] * n, pa.int32()), pa.array(doc_ids, pa.int64()),
                 pa.array(starts, pa.int64()), pa.array(lengths.astype(np.int64), pa.int64()), pa.array(crc, pa.int64())],
                names=["part", "segment", "id", "at", "n_tokens", "ids_crc32"])


def read_token_files(segments: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, start (over all files), n_tokens, ids_crc32."""
    heads = segments.select("part", "segment", "n_ids")
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per file
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("segment")
    starts = heads.join(before, "part").select(
        "part", "segment", (F.col("part_start") + F.sum("n_ids").over(inside) - F.col("n_ids")).alias("segment_start"))
    docs = segments.select("part", "segment", "data").mapInArrow(
        _read, "part int, segment int, id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["part", "segment"]).select(
        F.col("id").alias(id_col), (F.col("segment_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
