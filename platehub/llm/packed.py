"""Signatures packed for a shuffle: one row for each map batch and bucket.

A signature is a 64-bit key with a 62-bit id and two role bits (INDEX, PROBE);
fewer bytes of both may travel, where the caller resolves ids that share theirs.
Keys are dealt to buckets; a row holds the keys and ids of one bucket as byte
planes, so that the equal high bytes of ids compress away.  A bucket's rows meet
in one task, are sorted in numpy, and give the groups of equal keys that hold an
index and a probe of different ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .tokens import U, mix

INDEX, PROBE = 1, 2
SCHEMA = "bucket int, keys binary, ids binary"
#: Signatures in one bucket, about; a task sorts a bucket at a time.
BUCKET = 1_000_000
#: Signatures that a map task packs at a time.
FLUSH = 1_000_000


def buckets_for(signatures: int) -> int:
    return max(1, -(-signatures // BUCKET))


def planes(x: np.ndarray, width: int) -> bytes:
    """Bytes of the same significance together: the high ones compress away."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unplanes(raw: bytes, width: int) -> np.ndarray:
    part = np.frombuffer(raw, dtype=np.uint8).reshape(width, -1)
    out = np.zeros((part.shape[1], 8), dtype=np.uint8)
    out[:, :width] = part.T
    return out.view("<u8").ravel()


def tagged(ids, role: int) -> np.ndarray:
    """Ids (their low 62 bits) with a role."""
    return (np.asarray(ids).astype(np.int64).view(np.uint64) << U(2)) | U(role)


class Packer:
    """Gathers signatures and gives them as rows of SCHEMA."""

    def __init__(self, buckets: int, key_bytes: int = 5, id_bytes: int = 8):
        self.buckets, self.keys, self.ids, self.held = buckets, [], [], 0
        self.key_bytes, self.id_bytes = key_bytes, id_bytes

    def add(self, keys: np.ndarray, ids: np.ndarray) -> None:
        self.keys.append(keys)
        self.ids.append(ids)
        self.held += len(keys)

    def full(self) -> bool:
        return self.held >= FLUSH

    def take(self) -> pa.RecordBatch:
        none = [np.zeros(0, dtype=np.uint64)]
        key, idf = np.concatenate(self.keys or none), np.concatenate(self.ids or none)
        self.keys, self.ids, self.held = [], [], 0
        bucket = (key >> U(40)) % U(self.buckets)
        order = np.argsort(bucket, kind="stable")
        key, idf, bucket = key[order], idf[order], bucket[order]
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(key) else []
        ends = np.append(cut[1:], len(key)) if len(key) else []
        return rows(
            bucket[cut].astype(np.int32) if len(key) else [],
            [planes(key[a:b], self.key_bytes) for a, b in zip(cut, ends)],
            [planes(idf[a:b], self.id_bytes) for a, b in zip(cut, ends)],
        )


def rows(buckets, keys: list[bytes], ids: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(keys, pa.binary()), pa.array(ids, pa.binary())], ["bucket", "keys", "ids"])


class Groups:
    """Groups of equal keys in a bucket, ids ascending, each id once."""

    def __init__(self, table: pa.Table, key_bytes: int = 5, id_bytes: int = 8):
        key = np.concatenate([unplanes(x.as_py(), key_bytes) for x in table.column("keys")])
        idf = np.concatenate([unplanes(x.as_py(), id_bytes) for x in table.column("ids")])
        ordered = np.sort(key)
        again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        at = np.searchsorted(again, key)
        at[at == len(again)] = 0
        keep = again[at] == key if len(again) else np.zeros(len(key), dtype=bool)
        key, ids, role = key[keep], idf[keep].view(np.int64) >> 2, idf[keep] & U(3)
        order = np.lexsort((ids, key))
        key, ids, role = key[order], ids[order], role[order]
        begin = _begins(key, ids)
        role = np.bitwise_or.reduceat(role, begin) if len(begin) else role
        key, ids = key[begin], ids[begin]
        start = _begins(key)
        size = np.diff(np.append(start, len(key)))
        live = (size > 1) & (np.bitwise_or.reduceat(role, start) == U(INDEX | PROBE)) if len(start) else np.zeros(0, dtype=bool)
        inside = np.repeat(live, size)
        self.ids, self.role = ids[inside], role[inside]
        self.size = size[live]
        self.start = np.cumsum(self.size) - self.size
        self.group = np.repeat(np.arange(len(self.size)), self.size)

    def star(self) -> np.ndarray:
        """Distinct (smallest id, other id) of each group."""
        leader = np.repeat(self.ids[self.start], self.size)
        tail = self.ids != leader
        return np.unique(np.stack([leader[tail], self.ids[tail]], axis=1), axis=0)

    def members(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(group's name, id) of the groups of ``least`` ids or more; groups of
        the same members have one name and are given once."""
        if not len(self.start):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        name = np.add.reduceat(mix(self.ids.view(np.uint64) + U(1)), self.start)
        wide = np.flatnonzero(self.size >= least)
        _, once = np.unique(name[wide], return_index=True)
        chosen = np.zeros(len(self.start), dtype=bool)
        chosen[wide[once]] = True
        inside = chosen[self.group]
        return name.view(np.int64)[self.group[inside]], self.ids[inside]


def _begins(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(len(columns[0]), dtype=bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)
