"""Byte-level BPE by a global shuffle of distinct words.

Blocks of documents split their texts into pre-tokens and number their distinct
ones; a block's positions (the number of each pre-token, in order) go to the
block's task as compressed bytes, its words, packed by hash, to the words' tasks.
There each distinct word is encoded once for all blocks, and the ids go back to the
blocks that hold it, which reassemble their documents by position.  Decoding
looks ids up in the token-byte table (as many rows as the vocabulary has).
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Bytes of text after which a block is closed.
BLOCK_BYTES = 24 << 20


@functools.cache
def ranks(path: str) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}


@functools.cache
def _encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


@functools.cache
def token_table(path: str) -> list[bytes]:
    """Bytes by id."""
    table = ranks(path)
    out = [b""] * (max(table.values(), default=-1) + 1)
    for token, i in table.items():
        out[i] = token
    return out


def _zip(data: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def _unzip(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _pack_words(words: list[bytes]) -> bytes:
    return _zip(np.fromiter(map(len, words), np.uint32, len(words)).tobytes() + b"".join(words)) if words else b""


def _unpack_words(blob: bytes, n: int) -> list[bytes]:
    data = _unzip(blob)
    ends = (np.cumsum(np.frombuffer(data, np.uint32, n)) + 4 * n).tolist()
    return [data[a:b] for a, b in zip([4 * n, *ends], ends, strict=False)]


def _planes(x: np.ndarray) -> bytes:
    """Little-endian byte planes of 32-bit numbers; the upper ones are mostly zero."""
    return _zip(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unplanes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_unzip(blob), np.uint8).reshape(4, -1).T).view("<u4").ravel()


#: key: "b" and the block, or "s" and the shard of its words.
_PARTS = "key string, block string, n int, data binary, ids binary, sizes binary"
_PART_NAMES = ["key", "block", "n", "data", "ids", "sizes"]


def _split(pattern: str, n_shards: int):
    """For each block a row of its documents by position, and a row of words for each shard."""
    def block_rows(name: str, numbers: dict[str, int], ids: list, sizes: list[int], places: list) -> pa.RecordBatch:
        words = [w.encode("utf-8") for w in numbers]
        shards: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            shards.setdefault(xxhash.xxh3_64_intdigest(w) % n_shards, []).append(i)
        rows = [(f"b{name}", name, len(words), _planes(np.concatenate(places)), _pack_ids(ids),
                 np.array(sizes, np.uint32).tobytes())]
        rows += [(f"s{s}", name, len(own), _pack_words([words[i] for i in own]), np.array(own, np.uint32).tobytes(), None)
                 for s, own in shards.items()]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_PART_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        part, count = TaskContext.get().partitionId(), 0
        numbers: dict[str, int] = {}
        ids, sizes, places, total = [], [], [], 0
        for b in batches:
            for i, t in zip(b["id"].to_pylist(), b["text"].to_pylist(), strict=True):
                tokens = find(t) if t else []
                # a word that is new gets the next number
                places.append(np.fromiter([numbers.setdefault(w, len(numbers)) for w in tokens], np.uint32, len(tokens)))
                ids.append(i)
                sizes.append(len(tokens))
                total += len(t or "")
                if total > BLOCK_BYTES:
                    yield block_rows(f"{part}-{count}", numbers, ids, sizes, places)
                    count += 1
                    numbers, ids, sizes, places, total = {}, [], [], [], 0
        if ids:
            yield block_rows(f"{part}-{count}", numbers, ids, sizes, places)

    return run


def _pack_ids(ids: list[int | None]) -> bytes:
    null = np.array([i is None for i in ids], np.uint8)
    return null.tobytes() + np.array([i or 0 for i in ids], np.int64).tobytes()


def _unpack_ids(blob: bytes, n: int) -> list[int | None]:
    null = np.frombuffer(blob, np.uint8, n)
    return [None if z else i for z, i in zip(null.tolist(), np.frombuffer(blob, np.int64, n, n).tolist(), strict=True)]


_ANSWER = pa.schema([("key", pa.string()), ("n", pa.int32()), ("words", pa.binary()), ("lengths", pa.binary()), ("tokens", pa.binary())])


def _encode(path: str, pattern: str):
    """A shard: each distinct word is encoded once; every block gets the ids of its words."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        if not key[0].as_py().startswith("s"):
            return _ANSWER.empty_table()
        encode = _encoding(path, pattern).encode_ordinary
        known: dict[bytes, list[int]] = {}
        lengths, tokens = [], []
        for n, data in zip(table["n"].to_pylist(), table["data"], strict=True):
            ids = []
            for w in _unpack_words(data.as_py(), n):
                if w not in known:
                    known[w] = encode(w.decode("utf-8"))
                ids.append(known[w])
            lengths.append(_planes(np.fromiter(map(len, ids), np.uint32, len(ids))))
            tokens.append(_planes(np.fromiter(itertools.chain.from_iterable(ids), np.uint32)))
        return pa.table(
            [pa.array([f"b{x}" for x in table["block"].to_pylist()]), table["n"], table["ids"],
             pa.array(lengths, pa.binary()), pa.array(tokens, pa.binary())], schema=_ANSWER)

    return run


_RESULT = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.binary())])


def _assemble(path: str):
    """A block: the ids of its words by number, then its documents by position."""
    def run(key: tuple, docs: pa.Table, words: pa.Table) -> pa.Table:
        if not docs.num_rows or not key[0].as_py().startswith("b"):
            return _RESULT.empty_table()
        table = token_table(path)
        decimal = [str(i) for i in range(len(table))]
        doc = docs.slice(0, 1).to_pylist()[0]
        sizes, text, raw = [0] * doc["n"], [""] * doc["n"], [b""] * doc["n"]
        for row in words.to_pylist():
            flat, end = _unplanes(row["tokens"]).tolist(), 0
            for w, size in zip(np.frombuffer(row["words"], np.uint32).tolist(), _unplanes(row["lengths"]).tolist(), strict=True):
                ids = flat[end : end + size]
                end += size
                sizes[w] = size
                text[w] = ",".join([decimal[i] for i in ids])
                raw[w] = b"".join([table[i] for i in ids])
        counts = np.frombuffer(doc["sizes"], np.uint32).tolist()
        places, end, out = _unplanes(doc["data"]).tolist(), 0, []
        for n in counts:
            own = places[end : end + n]
            end += n
            out.append((sum([sizes[w] for w in own]), ",".join([text[w] for w in own]), b"".join([raw[w] for w in own])))
        ids = _unpack_ids(doc["ids"], len(counts))
        return pa.table([pa.array(ids, pa.int64()), *[pa.array(c) for c in zip(*out, strict=True)]], schema=_RESULT)

    return run


def encode_decode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, ids (decimal, joined by commas), decoded (binary).

    ``path`` is a rank file, ``pattern`` splits texts into pre-tokens.  Null and
    empty texts have no tokens.  Rows may repeat, and ids may be null: each row is
    encoded for itself.  Other columns are ignored, whatever their names; an empty
    table gives an empty result; a text longer than a block is a block of its own.
    """
    n = C.n_tasks(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # One exchange holds blocks and words, and both of its uses share it.
    parts = rows.mapInArrow(_split(pattern, n), _PARTS).repartition(n, "key").groupBy("key")
    answers = parts.applyInArrow(_encode(path, pattern), "key string, n int, words binary, lengths binary, tokens binary")
    return (
        parts.cogroup(answers.groupBy("key"))
        .applyInArrow(_assemble(path), "id long, n_tokens long, ids string, decoded binary")
        .withColumnRenamed("id", id_col)
    )
