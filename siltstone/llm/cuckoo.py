"""A cuckoo filter in numpy: approximate membership that also supports deletion."""

from __future__ import annotations

import numpy as np

SLOTS = 4
KICKS = 200


class Cuckoo:
    """Buckets of four 16-bit fingerprints, and a stash of whole keys for which no room was found.

    Never misses a key that was inserted and not deleted.
    """

    def __init__(self, bits: int | None = None, data: bytes | None = None):
        if data is None:
            self.stash = np.zeros(0, np.uint64)
            self.table = np.zeros((1 << bits, SLOTS), np.uint16)
        else:
            stashed = int(np.frombuffer(data, np.uint64, 1)[0])
            self.stash = np.frombuffer(data, np.uint64, stashed, 8).copy()
            self.table = np.frombuffer(data, np.uint16, -1, 8 + 8 * stashed).reshape(-1, SLOTS).copy()
        self.mask = np.uint64(len(self.table) - 1)

    @staticmethod
    def bits_for(keys: int) -> int:
        """Buckets, as a power of two, for so many keys at a load of 80 percent."""
        return max(1, int(keys / (SLOTS * 0.8)).bit_length())

    def to_bytes(self) -> bytes:
        return np.uint64(len(self.stash)).tobytes() + self.stash.tobytes() + self.table.tobytes()

    @staticmethod
    def _prints(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return (bucket ^ ((prints * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20))) & self.mask

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        prints = self._prints(hashes)
        first = hashes & self.mask
        return prints.astype(np.uint16), first.astype(np.int64), self._other(first, prints).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(hashes)
        wanted = prints[:, None]
        found = (self.table[first] == wanted).any(1) | (self.table[second] == wanted).any(1)
        return found | np.isin(hashes, self.stash) if len(self.stash) else found

    def _fill(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Put fingerprints into free slots of their buckets, many at once; says which found none."""
        order = np.argsort(buckets, kind="stable")
        sorted_buckets = buckets[order]
        begins = np.flatnonzero(np.diff(sorted_buckets, prepend=-1))
        turn = np.arange(len(order)) - np.repeat(begins, np.diff(begins, append=len(order)))
        free = self.table[sorted_buckets] == 0
        # The turn-th free slot of the bucket, if there is one.
        chosen = free & (np.cumsum(free, axis=1) == turn[:, None] + 1)
        placed = chosen.any(1)
        self.table[sorted_buckets[placed], chosen[placed].argmax(1)] = prints[order[placed]]
        left = np.ones(len(order), bool)
        left[order[placed]] = False
        return left

    def insert(self, hashes: np.ndarray) -> None:
        """Insert distinct keys."""
        if not len(hashes):
            return
        prints, first, second = self._places(hashes)
        left = np.flatnonzero(self._fill(prints, first))
        if len(left):
            left = left[self._fill(prints[left], second[left])]
        failed = [k for k in left.tolist() if not self._kick(int(prints[k]), int(second[k]))]
        self.stash = np.concatenate((self.stash, hashes[failed]))

    def _kick(self, mark: int, bucket: int) -> bool:
        """Move others to their second buckets to make room; undone if that leads nowhere."""
        moves = []
        for step in range(KICKS):
            row = self.table[bucket]
            free = np.flatnonzero(row == 0)
            if len(free):
                row[free[0]] = mark
                return True
            slot = (mark + step) % SLOTS
            moves.append((bucket, slot, int(row[slot])))
            mark, row[slot] = int(row[slot]), mark
            bucket = int(self._other(np.array([bucket], np.uint64), np.array([mark], np.uint64))[0])
        for bucket, slot, old in reversed(moves):
            self.table[bucket, slot] = old
        return False

    def delete(self, hashes: np.ndarray) -> np.ndarray:
        """Remove one fingerprint for each key; says which were found. Only for keys that were inserted."""
        found = np.isin(hashes, self.stash)
        self.stash = self.stash[~np.isin(self.stash, hashes)]
        prints, first, second = self._places(hashes)
        for k, (mark, a, b) in enumerate(zip(prints.tolist(), first.tolist(), second.tolist(), strict=True)):
            for bucket in () if found[k] else (a, b):
                at = np.flatnonzero(self.table[bucket] == mark)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    found[k] = True
                    break
        return found
