"""Byte-level BPE encoding and decoding, two tiers.

Tier one: a minimal perfect hash (hash and displace) over the vocabulary maps a
whole pre-token to its id; one comparison with the stored token confirms the
hit. Tier two, for misses: the bytes form a doubly linked list, a heap holds the
ranks of neighbouring pairs, and the lowest rank (leftmost on ties) is merged
until no pair is in the vocabulary.

The split pattern runs on chunks: a text may be cut before a single space
between two non-blank characters without changing any match, so a chunk met
before is taken from a bounded memo of the Python worker (two generations; the
older one is dropped). Whole texts are encoded; a batch of rows is held at a time.

Defined results: a null or empty text has no ids and decodes to nothing;
repeated rows are encoded each; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import text_of

VOCABULARY = "byte_bpe_50k.tiktoken"
MEMO = 400_000
_DOUBLE = re.compile(r"\s\s")
_MARKS = (",", ".")
_CUT = re.compile(r"(?<=\S) (?=\S)")


class PerfectHash:
    """Minimal perfect hash of byte strings to 0..n-1 (hash, displace, compare).

    Keys fall into n/2 buckets; the largest buckets first pick a displacement
    that sends all their keys to free slots. A bucket of one key names its slot
    (-1 - slot), so the last free slots are found without a search.
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = max(1, len(keys))
        self.buckets = max(1, (n + 1) // 2)
        self.shift = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * n
        self.order = [0] * n  # slot -> position in keys
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        hashes = [xxhash.xxh64_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            groups[h % self.buckets].append(i)
        taken, free = bytearray(n), 0
        for b in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            if not groups[b]:
                break
            if len(groups[b]) == 1:
                free = taken.index(0, free)
                d = -1 - free
            else:
                d = 0
                while not self._fits([hashes[i] for i in groups[b]], d, taken):
                    d += 1
            self.shift[b] = d
            for i in groups[b]:
                s = self._slot(hashes[i], d)
                taken[s], self.keys[s], self.order[s] = 1, keys[i], i

    def _slot(self, h: int, d: int) -> int:
        if d < 0:
            return -1 - d
        x = (h ^ d * 0x9E3779B97F4A7C15) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
        return (x >> 32) % self.n

    def _fits(self, hashes: list[int], d: int, taken: bytearray) -> bool:
        seen = set()
        for h in hashes:
            s = self._slot(h, d)
            if taken[s] or s in seen:
                return False
            seen.add(s)
        return True

    def get(self, key: bytes) -> int:
        """Position of ``key`` in the list it was built from, -1 if it isn't there."""
        h = xxhash.xxh64_intdigest(key)
        s = self._slot(h, self.shift[h % self.buckets])
        return self.order[s] if self.keys[s] == key else -1


class Codec(dict):
    """Memo chunk -> ids (16 or 32 bits each), filled on a miss."""

    def __init__(self, path: str, pattern: str, memo: int = MEMO):
        super().__init__()
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        by_rank = {int(r): base64.b64decode(t) for t, r in pairs}
        self.tokens = [by_rank.get(i, b"") for i in range(max(by_rank) + 1)]
        known = sorted(by_rank)
        self.ranks = known
        self.table = PerfectHash([by_rank[r] for r in known])
        self.pairs = {by_rank[r]: r for r in known}  # rank of what a pair makes
        self.split = regex.compile(pattern)
        self.memo, self.old, self.pre = memo, {}, {}
        self.mark: dict[str, bytes] = {}
        self.code = "H" if len(self.tokens) <= 1 << 16 else "I"
        self.kind = np.dtype(self.code)
        self.mark.update({m: self.chunk_ids(m) for m in _MARKS})

    def whole(self, piece: bytes) -> int:
        """Tier one: id of a pre-token in the vocabulary, else -1."""
        at = self.table.get(piece)
        return -1 if at < 0 else self.ranks[at]

    def merge(self, piece: bytes) -> list[int]:
        """Tier two: ids of a pre-token that is not in the vocabulary."""
        n, rank = len(piece), self.pairs.get
        wide = n.bit_length()
        low, both = (1 << wide) - 1, 2 * wide  # heap entry: rank, start, end in one number
        after = list(range(1, n + 1))    # where the part after this one starts
        before = list(range(-1, n - 1))  # where the part before starts
        heap = [r << both | i << wide | i + 2
                for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i, end = top >> wide & low, top & low
            j = after[i]
            if not 0 <= j < n or after[j] != end:
                continue  # a part has gone or has grown since
            after[i], after[j] = end, -1
            if end < n:
                before[end] = i
                stop = after[end]
                if (r := rank(piece[i:stop])) is not None:
                    heappush(heap, r << both | i << wide | stop)
            if (p := before[i]) >= 0 and (r := rank(piece[p:end])) is not None:
                heappush(heap, r << both | p << wide | end)
        out, i = [], 0
        while i < n:
            out.append(self.pairs[piece[i:after[i]]])
            i = after[i]
        return out

    def pre_token(self, piece: str) -> bytes:
        raw = piece.encode()
        whole = self.whole(raw)
        return array(self.code, self.merge(raw) if whole < 0 else (whole,)).tobytes()

    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of any text, by the split pattern."""
        out = []
        for piece in self.split.findall(chunk):
            if piece[0] == " " and piece[1:].isalpha():
                got = self[piece[1:]]
            elif (got := self.pre.get(piece)) is None:
                got = self.pre_token(piece)
                if len(piece) <= 64:
                    if len(self.pre) >= self.memo // 4:
                        self.pre.clear()
                    self.pre[piece] = got
            out.append(got)
        return b"".join(out)

    def __missing__(self, chunk: str) -> bytes:
        """Ids of ``chunk`` with a space before it."""
        got = self.old.get(chunk)
        if got is None:
            if chunk.isalpha():  # one pre-token
                got = self.pre_token(" " + chunk)
            elif chunk[-1:] in _MARKS and chunk[:-1].isalpha():
                # two pre-tokens; the word alone is in the memo more often
                return self[chunk[:-1]] + self.mark[chunk[-1]]
            else:
                return self.chunk_ids(" " + chunk)
        if len(chunk) <= 64:
            if len(self) >= self.memo:
                self.old = dict(self)
                self.clear()
            self[chunk] = got
        return got

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, self.kind)
        if text[0].isspace() or text[-1].isspace() or _DOUBLE.search(text):
            chunks = _CUT.split(text)
        else:
            chunks = text.split(" ")
        first = self.chunk_ids(chunks[0])
        return np.frombuffer(first + b"".join(map(self.__getitem__, chunks[1:])), self.kind)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each Python worker."""
    return Codec(path, pattern)


def _setting(vocabulary: str | None, pattern: str | None) -> tuple[str, str]:
    return vocabulary or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN


def encode(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text."""
    setting = _setting(vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(*setting)
        for b in batches:
            ids = [own.encode(t).astype(np.int32) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _rows(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, bytes) of the ids; null ids are none."""
    setting = _setting(vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(*setting)
        for b in batches:
            raw = [own.decode(np.array(x or [], np.int32)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, then decodes the ids.

    Encoding and decoding share a task, so the ids never cross to the JVM.
    """
    setting = _setting(vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(*setting)
        decimal = [str(i) for i in range(len(own.tokens))]
        for b in batches:
            n, sent, back = [], [], []
            for text in b.column(1).to_pylist():
                ids = own.encode(text)
                n.append(len(ids))
                sent.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids.tolist())).encode()).hexdigest())
                back.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(sent, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
