"""Look up many 64-bit hashes in a sorted table by whole-array operations."""

from __future__ import annotations

import numpy as np


class HashIndex:
    """Place of each key in a sorted array of distinct hashes, or -1.

    The high bits of a hash say where its bucket begins; as hashes spread
    evenly, a bucket holds about one key and few steps find any.
    """

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(1, int(len(keys)).bit_length())
        edges = np.arange((1 << self.bits) + 1, dtype=np.uint64)
        if len(keys):
            buckets = keys >> np.uint64(64 - self.bits)
            self.first = np.searchsorted(buckets, edges).astype(np.int32)
        else:
            self.first = np.zeros(len(edges), np.int32)
        self.depth = int(np.diff(self.first).max(initial=0))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        bucket = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.first[bucket], self.first[bucket + 1]
        found = np.full(len(hashes), -1, np.int64)
        open_rows = np.flatnonzero(at < end)
        for _ in range(self.depth):
            if not len(open_rows):
                break
            place = at[open_rows]
            same = self.keys[place] == hashes[open_rows]
            found[open_rows[same]] = place[same]
            open_rows = open_rows[~same]
            at[open_rows] += 1
            open_rows = open_rows[at[open_rows] < end[open_rows]]
        return found
