"""Blocked Bloom filters over 64-bit hashes: filled by Spark, probed with numpy.

A filter is one array of 64-bit words. A shard (a group of keys that is probed
apart, such as the words of one length) owns a run of 512-bit blocks; a key sets
``PROBES`` bits inside one block of its shard, so a probe touches one cache line.
A key that was put in is always found; others are found with a small chance, so
what is found has to be joined with the keys afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each key, bits set for each key.
BITS_A_KEY = 16
PROBES = 6
#: Size of the largest filter that is broadcast.
MOST_BYTES = 1 << 24
_WORDS = 8  # of 64 bits in a block


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hashes with all bits stirred."""
    x = h ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Shape:
    """Where the shards lie: ``first`` block and number of ``blocks`` of each."""

    def __init__(self, keys: dict[int, int], most_bytes: int = MOST_BYTES):
        """``keys``: how many keys each shard has. Where they would need more than ``most_bytes``,
        every shard shrinks alike and more foreign keys are found."""
        bits = min(BITS_A_KEY, most_bytes * 8 / max(1, sum(keys.values())))
        self.blocks = {s: max(1, int(n * bits) // 512) for s, n in keys.items()}
        self.first, at = {}, 0
        for s in sorted(self.blocks):
            self.first[s] = at
            at += self.blocks[s]
        self.words = at * _WORDS

    def __contains__(self, shard: int) -> bool:
        return shard in self.blocks

    def base(self, shard: int, h: np.ndarray) -> np.ndarray:
        """First word of the block of each key."""
        block = (h >> np.uint64(32)) * np.uint64(self.blocks[shard]) >> np.uint64(32)
        return (block.astype(np.int64) + self.first[shard]) * _WORDS


def _bit(g: np.ndarray, i: int) -> np.ndarray:
    return (g >> np.uint64(9 * i)) & np.uint64(511)


def fill(keys: DataFrame, shape: Shape) -> np.ndarray:
    """The filter's words. ``keys``: (shard int, h long), distinct or not.

    Each task ors its own keys; Spark ors the words of all tasks. The driver gets
    the words that aren't zero: at most the filter's size.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard, h = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            h = h.view(np.uint64)
            at, bits = [], []
            for s in np.unique(shard).tolist():
                own = h[shard == s]
                base, g = shape.base(s, own), mixed(own, 1)
                for i in range(PROBES):
                    bit = _bit(g, i)
                    at.append(base + (bit >> np.uint64(6)).astype(np.int64))
                    bits.append(np.uint64(1) << (bit & np.uint64(63)))
            if not at:
                continue
            where, what = np.concatenate(at), np.concatenate(bits)
            order = np.argsort(where, kind="stable")
            where, what = where[order], what[order]
            starts = np.flatnonzero(np.diff(where, prepend=-1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(where[starts]), pa.array(np.bitwise_or.reduceat(what, starts).view(np.int64))], ["at", "bits"])

    words = np.zeros(max(1, shape.words), np.uint64)
    found = (keys.select("shard", "h").mapInArrow(run, "at long, bits long")
             .groupBy("at").agg(F.bit_or("bits").alias("bits"))).toArrow()
    words[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return words


def found(words: np.ndarray, shape: Shape, shard: int, h: np.ndarray) -> np.ndarray:
    """Positions in ``h`` of the hashes that may be keys of ``shard``."""
    if shard not in shape or not len(h):
        return np.zeros(0, np.int64)
    base, g, left = shape.base(shard, h), mixed(h, 1), np.arange(len(h))
    for i in range(PROBES):
        bit = _bit(g, i)
        ok = (words[base + (bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)
        keep = np.flatnonzero(ok)
        base, g, left = base[keep], g[keep], left[keep]
    return left
