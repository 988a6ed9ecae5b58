"""Cuckoo filters over 64-bit key hashes: approximate membership that supports deletion.

Two candidate buckets per key, four 16-bit tags per bucket; a key moves between its buckets by the
hash of its tag, so tags can be evicted without their keys. Filters are built and probed in bulk.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
LOAD = 0.84
KICKS = 500


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: well spread bits for close inputs."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class CuckooFilter:
    def __init__(self, capacity: int) -> None:
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, capacity) / (SLOTS * LOAD)))))
        self.tags = np.zeros((buckets, SLOTS), dtype=np.uint16)

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter of distinct keys; it grows when a key finds no place."""
        keys = np.unique(keys.astype(np.uint64))
        size = len(keys)
        while True:
            made = cls(size)
            if made.insert(keys):
                return made
            size = 2 * max(size, SLOTS)

    @classmethod
    def from_bytes(cls, blob: bytes) -> CuckooFilter:
        made = cls.__new__(cls)
        made.tags = np.frombuffer(blob, dtype=np.uint16).reshape(-1, SLOTS).copy()
        return made

    def to_bytes(self) -> bytes:
        return self.tags.tobytes()

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First bucket, second bucket and tag of every key."""
        mix = mixed(keys)
        tag = ((mix >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        first = mix & np.uint64(len(self.tags) - 1)
        return first, self.other(first, tag), tag

    def other(self, bucket: np.ndarray, tag: np.ndarray) -> np.ndarray:
        return bucket ^ (mixed(np.asarray(tag)) & np.uint64(len(self.tags) - 1))

    def insert(self, keys: np.ndarray) -> bool:
        """Put keys in; False when one found no place, the filter then needs to grow."""
        first, second, tag = self.places(keys)
        waiting = np.arange(len(keys))
        for bucket in (first, second):
            for slot in range(SLOTS):
                at = bucket[waiting]
                free = np.flatnonzero(self.tags[at, slot] == 0)
                _, winner = np.unique(at[free], return_index=True)
                chosen = waiting[free[winner]]
                self.tags[bucket[chosen], slot] = tag[chosen]
                waiting = np.delete(waiting, free[winner])
        rng = np.random.default_rng(len(keys))
        return all(self.evict(second[i], tag[i], rng) for i in waiting)

    def evict(self, bucket: np.uint64, tag: np.uint16, rng: np.random.Generator) -> bool:
        for _ in range(KICKS):
            free = np.flatnonzero(self.tags[bucket] == 0)
            if len(free):
                self.tags[bucket, free[0]] = tag
                return True
            slot = int(rng.integers(SLOTS))
            tag, self.tags[bucket, slot] = self.tags[bucket, slot], tag
            bucket = self.other(np.array([bucket]), np.array([tag]))[0]
        return False

    def contains(self, keys: np.ndarray) -> np.ndarray:
        first, second, tag = self.places(keys)
        found = self.tags[first] == tag[:, None]
        return (found | (self.tags[second] == tag[:, None])).any(axis=1)

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that were put in; each removes one tag."""
        first, second, tag = self.places(keys)
        for a, b, t in zip(first, second, tag, strict=True):
            for bucket in (a, b):
                hit = np.flatnonzero(self.tags[bucket] == t)
                if len(hit):
                    self.tags[bucket, hit[0]] = 0
                    break
