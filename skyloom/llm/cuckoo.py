"""A sharded cuckoo filter of 128-bit keys, all shards in one array.

Each key has a 16-bit fingerprint in one of two buckets of four slots; the other
bucket is found from the fingerprint alone, so keys can be deleted again.  A shard
that can't take a key is saturated: it answers "maybe" for every key, and so never
loses one.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
_U = np.uint64


def _parts(digests: bytes, n_shards: int, n_buckets: int):
    h = np.frombuffer(digests, "<u8").reshape(-1, 2)
    shard = (h[:, 0] % _U(n_shards)).astype(np.int64)
    finger = ((h[:, 1] >> _U(48)) | _U(1)).astype(np.uint16)  # 0 marks a free slot
    first = ((h[:, 1] & _U(0xFFFFFFFF)) % _U(n_buckets)).astype(np.int64)
    return shard, finger, first


def _other(bucket, finger, n_buckets: int):
    """n_buckets is a power of two."""
    return bucket ^ ((finger.astype(np.int64) * 0x5BD1E995) & (n_buckets - 1)) if hasattr(finger, "astype") else (
        bucket ^ ((int(finger) * 0x5BD1E995) & (n_buckets - 1)))


class Shard:
    """One shard's buckets, for insertions and deletions."""

    def __init__(self, n_buckets: int, table: bytes | None = None):
        self.n_buckets = n_buckets
        self.saturated = table is not None and not len(table)
        blank = np.zeros((n_buckets, SLOTS), np.uint16)
        self.table = np.frombuffer(table, np.uint16).reshape(n_buckets, SLOTS).copy() if table else blank

    def _put(self, bucket: int, finger: int) -> bool:
        row = self.table[bucket]
        for j in range(SLOTS):
            if not row[j]:
                row[j] = finger
                return True
        return False

    def insert(self, digests: bytes) -> None:
        if self.saturated:
            return
        _, fingers, firsts = _parts(digests, 1, self.n_buckets)
        for f, b in zip(fingers.tolist(), firsts.tolist(), strict=True):
            if self._put(b, f) or self._put(_other(b, f, self.n_buckets), f):
                continue
            for kick in range(500):
                j = kick % SLOTS
                f, self.table[b, j] = int(self.table[b, j]), f
                b = _other(b, f, self.n_buckets)
                if self._put(b, f):
                    break
            else:
                self.saturated = True
                return

    def delete(self, digests: bytes) -> None:
        """Keys that were inserted.  A saturated shard has lost some, and stays as it is."""
        if self.saturated:
            return
        _, fingers, firsts = _parts(digests, 1, self.n_buckets)
        for f, b in zip(fingers.tolist(), firsts.tolist(), strict=True):
            for at in (b, _other(b, f, self.n_buckets)):
                j = np.flatnonzero(self.table[at] == f)
                if len(j):
                    self.table[at, j[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return b"" if self.saturated else self.table.tobytes()


class Filters:
    """All shards, read only: probes are a gather over one array."""

    def __init__(self, n_shards: int, n_buckets: int, tables: dict[int, bytes]):
        self.n_shards, self.n_buckets = n_shards, n_buckets
        self.table = np.zeros((n_shards, n_buckets, SLOTS), np.uint16)
        self.saturated = np.zeros(n_shards, bool)
        for s, raw in tables.items():
            if raw:
                self.table[s] = np.frombuffer(raw, np.uint16).reshape(n_buckets, SLOTS)
            else:
                self.saturated[s] = True

    def maybe(self, digests: bytes) -> np.ndarray:
        shard, finger, first = _parts(digests, self.n_shards, self.n_buckets)
        other = _other(first, finger, self.n_buckets)
        f = finger[:, None]
        hit = (self.table[shard, first] == f).any(axis=1) | (self.table[shard, other] == f).any(axis=1)
        return hit | self.saturated[shard]
