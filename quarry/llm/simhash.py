"""SimHash near-duplicates by bit-sliced comparison.

1. Fingerprints: Arrow batches, 64 majority bits over the XXH64 of every 3-word
   shingle of the whole text. Stored once (id, text hash, fingerprint).
2. Equal fingerprints collapse to one row (partial aggregation, so a group of
   copies of any size is one row).
3. Candidate buckets: the 64 bits are cut into 5 parts; two fingerprints within
   3 bits agree on at least 2 of them, so the 10 pairs of parts as bucket keys
   (25 or 26 bits each) miss no link.
4. A bucket holds at most ``TILE`` fingerprints; a larger one is dealt into
   chunks, and every pair of chunks is a tile of its own. Tiles are compared
   with vertical bit planes: 64 distances per machine word are counted with
   carry-save adders, and rows whose 64 distances all passed the radius leave
   early. A tile returns a spanning forest of its links, never all pairs.
5. Connected components by alternating large and small stars.

Defined results: a text without words (null, empty, white space) has
fingerprint zero, linked like any other. Rows with a null id take part; the
component is the smallest id that is not null, null if there is none. Repeated
rows are copies of each other. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import framed, staged, text_of, unframed
from quarry.llm.graph import connected_components

SHINGLE = 3
RADIUS = 3
SEED = 42
TILE = 16384
#: Tiles of fewer rows are compared in one block of about so many rows; what it
#: finds across tiles are links as well.
TOGETHER = 512
#: First bit of each of the RADIUS + 2 parts; two of them agree for every link.
CUTS = (0, 13, 26, 39, 52, 64)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_STEP = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of UTF-8 text; 0 without words."""
    words = text.translate(_LOWER).split()  # bytes.split: exactly \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_digest
    if n < 1:
        return int.from_bytes(digest(joined, seed), "big")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _STEP):
        stop = min(n, at + _STEP)
        spans = zip(starts[at:stop].tolist(), ends[at + shingle - 1:stop + shingle - 1].tolist())
        raw = b"".join([digest(joined[a:b], seed) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp): one row per document, fp as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("text_hash"),
                       text_of().cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t) for t in b.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fp.view(np.int64))], ["doc_id", "text_hash", "fp"])

    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _keys() -> Column:
    """The 10 bucket keys of a fingerprint: table number and the bits of two parts."""
    fp = F.col("fp")

    def part(k: int) -> Column:
        width = CUTS[k + 1] - CUTS[k]
        return F.shiftrightunsigned(fp, 64 - CUTS[k + 1]).bitwiseAND(F.lit((1 << width) - 1))

    return F.array(*[
        F.struct(F.lit(t).alias("t"), (F.shiftleft(part(i), 13) + part(j)).alias("key"))
        for t, (i, j) in enumerate(combinations(range(5), 2))])


def near_pairs(planes: np.ndarray, probes: np.ndarray, size: int,
               radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(probe index, block positions within ``radius``) by bit-sliced counting.

    ``planes``: 64 rows of ``size`` bits in 64-bit words (one row per bit of the
    fingerprints). Counters are vertical as well: digit d of the 64 distances of
    a word is one word, added to with XOR and AND; ``over`` marks distances
    beyond the radius. A probe whose words are all over leaves the loop.
    """
    digits = max(1, radius.bit_length())  # counts up to 2**digits - 1 >= radius
    words = planes.shape[1]
    step = max(1, (1 << 18) // max(1, words))
    tail = np.zeros(words * 64, np.uint8)
    tail[size:] = 1
    pad = np.packbits(tail, bitorder="little").view(np.uint64)
    for at in range(0, len(probes), step):
        live = np.arange(at, min(len(probes), at + step))
        over = np.repeat(pad[None, :], len(live), axis=0)
        count = [np.zeros_like(over) for _ in range(digits)]
        for j in range(64):
            flip = np.where(probes[live] >> np.uint64(63 - j) & np.uint64(1), ~np.uint64(0), np.uint64(0))
            carry = planes[j][None, :] ^ flip[:, None]
            for d in range(digits):
                count[d], carry = count[d] ^ carry, count[d] & carry
            over |= carry
            if radius + 1 < 1 << digits:  # the digits can hold more than the radius
                over |= _exceeds(count, radius)
            if j >= 7 and j % 4 == 3:
                stay = ~(over == ~np.uint64(0)).all(axis=1)
                if not stay.all():
                    live, over, count = live[stay], over[stay], [c[stay] for c in count]
                    if not len(live):
                        break
        if len(live):
            near = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")
            for row, k in zip(near, live.tolist(), strict=True):
                yield k, np.flatnonzero(row)


def _exceeds(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Words of the distances whose digits spell a number above ``radius``."""
    more = np.zeros_like(count[0])
    same = ~np.zeros_like(count[0])
    for d in reversed(range(len(count))):
        if radius >> d & 1:
            same = same & count[d]
        else:
            more = more | (same & count[d])
            same = same & ~count[d]
    return more


def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 rows: bit 63-j of every value, packed little-endian into 64-bit words."""
    n = len(values)
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(n, 8), axis=1)
    wide = np.zeros((64, (n + 63) // 64 * 64), np.uint8)
    wide[:, :n] = bits.T
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


def tile_forest(first: np.ndarray, second: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Spanning forest (positions) of the links inside ``first``, or between both arrays."""
    block = first if second is None else np.concatenate([first, second])
    planes, root = bit_planes(first), np.arange(len(block))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    probes = first if second is None else second
    shift = 0 if second is None else len(first)
    for k, near in near_pairs(planes, probes, len(first), radius):
        if len(near) > (second is None):
            ends = {find(int(x)) for x in near} | {find(k + shift)}
            top = min(ends)
            for x in ends:
                root[x] = top
    return [(x, r) for x in range(len(block)) if (r := find(x)) != x]


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect what is within ``radius`` bits; ``fps`` has distinct ``fp``."""
    keyed = fps.select("fp", F.explode(_keys()).alias("k")).select("fp", "k.t", "k.key")
    crowd = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / F.lit(tile * 0.9)).cast("int")
    dealt = (keyed.join(crowd, ["t", "key"])
             .withColumn("chunks", chunks)
             .withColumn("own", F.pmod(F.xxhash64("fp", "t"), F.col("chunks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("t", "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                     "own", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: tuple | None = None
        own: list[np.ndarray] = []
        fp: list[np.ndarray] = []
        small: list[np.ndarray] = []  # whole tiles of few rows, compared together

        def found(first: np.ndarray, second: np.ndarray | None) -> Iterator[pa.RecordBatch]:
            both = first if second is None else np.concatenate([first, second])
            at = np.array(tile_forest(first, second, radius), np.int64).reshape(-1, 2)
            if len(at):
                signed = both.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed[at[:, 0]]), pa.array(signed[at[:, 1]])], ["a", "b"])

        def done(last: bool = False) -> Iterator[pa.RecordBatch]:
            if head is not None:
                side, values = np.concatenate(own), np.concatenate(fp).view(np.uint64)
                if head[2] != head[3]:
                    first, second = values[side == head[2]], values[side == head[3]]
                    if len(first) and len(second):
                        yield from found(first, second)
                elif len(values) >= TOGETHER:
                    yield from found(values, None)
                else:
                    small.append(values)
            if small and (last or sum(map(len, small)) >= TOGETHER):
                yield from found(np.unique(np.concatenate(small)), None)
                small.clear()

        for b in batches:
            t, key, x, y, o, f = (b.column(i).to_numpy() for i in range(6))
            new = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (key[1:] != key[:-1])
                                       | (x[1:] != x[:-1]) | (y[1:] != y[:-1])]) if len(t) else []
            for a, e in zip(new, [*new[1:], len(t)], strict=True):
                at = (t[a], key[a], x[a], y[a])
                if at != head:
                    yield from done()
                    head, own, fp = at, [], []
                own.append(o[a:e])
                fp.append(f[a:e])
        yield from done(last=True)

    order = ["t", "key", "x", "y"]
    # a stated number of partitions: few bytes here are much work, and must not be coalesced
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(parts, *order).sortWithinPartitions(*order)
            .mapInArrow(run, "a long, b long").distinct())


def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component): smallest fingerprint (signed) reachable from each distinct one."""
    fps = staged(prints.select("fp").distinct(), "simhash_fps")
    edges = staged(links(fps, radius), "simhash_links")
    found = connected_components(edges)
    return (fps.join(found, fps.fp == found.node, "left")
            .select("fp", F.coalesce("component", "fp").alias("component")))


def simhash_near_dups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row."""
    prints = staged(fingerprints(docs), "simhash_prints")
    found = classes(prints, radius)
    lowest = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    named = found.join(lowest, "fp")
    names = staged(named.groupBy("component").agg(F.min("low").alias("component_id"))
                   .join(named.select("fp", "component"), "component")
                   .select("fp", "component_id"), "simhash_names")
    return (prints.join(names, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of each component: the smallest id (then text hash) stays.

    Only ids and hashes meet in the grouping; the texts are shuffled once, for
    the semi join with the rows that stay.
    """
    prints = staged(fingerprints(docs), "simhash_prints")
    found = classes(prints, radius)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    # one row per fingerprint first: partial aggregation takes in the hot groups
    heads = prints.groupBy("fp").agg(first.alias("head"))
    stay = staged(heads.join(found, "fp").groupBy("component").agg(F.min("head").alias("head"))
                  .select(F.col("head.doc_id").alias("_id"), F.col("head.text_hash").alias("_hash")),
                  "simhash_stay")
    kept = (framed(docs, F.col("doc_id").cast("long").alias("_key"), F.xxhash64("text").alias("_h"))
            .join(stay, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash")), "left_semi"))
    again = (prints.join(stay, prints.doc_id.eqNullSafe(stay["_id"])
                         & (prints.text_hash == stay["_hash"]), "left_semi")
             .groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count())
    if again:  # rows repeated with their id: one of them
        kept = kept.dropDuplicates(["_key", "_h"])
    return kept.select(*unframed(docs.columns))
