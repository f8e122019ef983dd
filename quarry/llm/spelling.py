"""Spelling variant grouping: Bloom-guided neighbourhoods.

1. Words of all texts are counted (partial counts a task, one sum a word).
2. The vocabulary's words fill blocked Bloom filters, one shard a word length.
   They hold ``BITS_A_KEY`` bits a word and are broadcast; a vocabulary that needs
   more than ``MOST_BYTES`` is dealt by hash into slices that are probed in turn,
   so that no broadcast grows with the data.
3. Every word generates its edits and probes the shards: the longer of two words
   deletes one letter, and of two words of one length the smaller replaces a
   letter by a greater one, so a pair is met once. Edits are hashes worked out
   from the word's polynomial hash, not strings; only a positive becomes a string.
4. Positives are shuffled to an exact join with the vocabulary, which removes the
   false ones. Each pair is then read from both sides: number of near words, and
   the near word of largest count.
5. Forms have at least ``DOMINANCE`` times the count of the word below, so chains
   are short; pointer jumping (each round doubles the step) finds their ends.

All characters of a word are Latin-1, so a word is a byte string of one byte a
code point, and byte order is code-point order.

Defined results: null and empty texts have no words; a null doc_id counts as the
empty text in the hashed key; repeated rows count as often as they stand there; an
empty table gives no rows; ties go to the smaller word; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import blocked_bloom
from quarry.llm.common import staged, text_of

LEAST_LENGTH = 6
LEAST_COUNT = 5
DOMINANCE = 5
#: A run loses a letter if this divides the checksum of its key.
SLIP = 199
#: Words that a task counts before it sends them on; cells of edits worked on at once.
HELD = 300_000
CELLS = 1 << 19
_BASE = 0x9E3779B97F4A7C15  # odd: the polynomial's powers have inverses
#: Latin-1 bytes: A-Z lowered, letters kept, everything else a blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str) -> list[str]:
    """Runs of letters, A-Z lowered, of at least ``LEAST_LENGTH`` code points."""
    plain = text.encode("latin-1", "replace").translate(_LETTERS).decode("latin-1")
    return [w for w in plain.split(" ") if len(w) >= LEAST_LENGTH]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): all words of at least ``LEAST_LENGTH`` code points, however rare."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            some = [(w, k) for w, k in total.items() if k and len(w) >= LEAST_LENGTH]
            total.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in some], pa.string()), pa.array([k for _, k in some], pa.int64())], ["word", "n"])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = runs(text)
                total.update(words)
                key = crc32(f"{'' if doc is None else doc}:".encode())
                for w in set(words):
                    h = crc32(w.encode(), key)
                    if not h % SLIP:
                        k, at = words.count(w), h % len(w)
                        total[w] -= k
                        total[w[:at] + w[at + 1:]] += k
                if len(total) >= HELD:
                    yield flush()
        if total:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame) -> DataFrame:
    """Stored (word, n) of at least ``LEAST_COUNT`` occurrences."""
    return staged(word_counts(docs).where(F.col("n") >= LEAST_COUNT), "spelling_words")


def _powers(length: int) -> np.ndarray:
    out = np.empty(length + 1, np.uint64)
    out[0] = 1
    out[1:] = np.uint64(_BASE)
    return np.cumprod(out, dtype=np.uint64)


def _matrix(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)


def word_hashes(letters: np.ndarray) -> np.ndarray:
    """Hashes of the words that are the rows of ``letters``."""
    return blocked_bloom.mixed((letters.astype(np.uint64) * _powers(letters.shape[1])[:-1]).sum(1, dtype=np.uint64))


def slice_of(h: np.ndarray, slices: int) -> np.ndarray:
    return blocked_bloom.mixed(h, 2) % np.uint64(slices)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, positions of the words of that length), in portions that bound the arrays."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(size).tolist():
        at = np.flatnonzero(size == length)
        step = max(1, CELLS // (length * 16))
        for a in range(0, len(at), step):
            yield length, at[a:a + step]


def edits(letters: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, position, rows, put letters or -1, hashes) of all edits of equally long words.

    Deletions at the first letter of a run of equal letters only (the others give the
    same word), replacements by greater letters of ``alphabet``.
    """
    m, length = letters.shape
    power = _powers(length)
    term = letters.astype(np.uint64) * power[:-1]
    before = np.zeros((m, length + 1), np.uint64)
    np.cumsum(term, axis=1, out=before[:, 1:])
    total = before[:, -1]
    back = np.uint64(pow(_BASE, -1, 1 << 64))
    rows = np.arange(m)
    for i in range(length):
        own = rows if i == 0 else np.flatnonzero(letters[:, i] != letters[:, i - 1])
        gone = before[own, i] + (total[own] - before[own, i + 1]) * back
        yield length - 1, i, own, np.full(len(own), -1), blocked_bloom.mixed(gone)
        who, put = np.nonzero(alphabet[None, :] > letters[:, i, None])
        change = (alphabet[put].astype(np.uint64) - letters[who, i].astype(np.uint64)) * power[i]
        yield length, i, who, alphabet[put].astype(np.int64), blocked_bloom.mixed(total[who] + change)


def _keys(words: DataFrame, slices: int) -> DataFrame:
    """(shard, h, slice) of each word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_words = b.column(0).to_pylist()
            for length, at in _by_length(all_words):
                h = word_hashes(_matrix([all_words[i].encode("latin-1") for i in at.tolist()], length))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h), length, np.int32)), pa.array(h.view(np.int64)),
                     pa.array(slice_of(h, slices).astype(np.int32))], ["shard", "h", "slice"])

    return words.select("word").mapInArrow(run, "shard int, h long, slice int")


def _alphabet(words: DataFrame) -> list[int]:
    """Code points of the vocabulary's letters: at most 90."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for b in batches:
            seen.update(*b.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([ord(c) for c in seen], pa.int32())], ["c"])

    return sorted(r["c"] for r in words.select("word").mapInArrow(run, "c int").distinct().collect())


def candidates(words: DataFrame, most_bytes: int = blocked_bloom.MOST_BYTES) -> DataFrame:
    """(word, n, other): edits that the filters know; true pairs once, and a few false ones."""
    spark = words.sparkSession
    count = {r["l"]: r["c"] for r in words.groupBy(F.length("word").alias("l")).agg(F.count("*").alias("c")).collect()}
    slices = max(1, -(-sum(count.values()) * blocked_bloom.BITS_A_KEY // (8 * most_bytes)))
    alphabet = np.array(_alphabet(words), np.uint8)
    keys = _keys(words, slices)
    if slices > 1:
        keys = staged(keys, "spelling_keys")
    # equal words of work for every task
    dealt = words.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), "word").sortWithinPartitions(F.length("word"))
    parts = []
    for k in range(slices):
        shape = blocked_bloom.Shape({s: -(-c // slices) for s, c in count.items()}, most_bytes)
        sent = spark.sparkContext.broadcast(blocked_bloom.fill(keys.where(F.col("slice") == k), shape))

        def probe(batches: Iterator[pa.RecordBatch], k: int = k, shape=shape, sent=sent) -> Iterator[pa.RecordBatch]:
            bits = sent.value
            for b in batches:
                all_words, n = b.column(0).to_pylist(), b.column(1).to_numpy()
                for length, at in _by_length(all_words):
                    own = [all_words[i] for i in at.tolist()]
                    who, other = [], []
                    for target, i, rows, put, h in edits(_matrix([w.encode("latin-1") for w in own], length), alphabet):
                        if target not in shape:
                            continue
                        if slices > 1:
                            mine = np.flatnonzero(slice_of(h, slices) == k)
                            rows, put, h = rows[mine], put[mine], h[mine]
                        hit = blocked_bloom.found(bits, shape, target, h)
                        for r, c in zip(rows[hit].tolist(), put[hit].tolist(), strict=True):
                            w = own[r]
                            who.append(r)
                            other.append(w[:i] + (chr(c) if c >= 0 else "") + w[i + 1:])
                    if who:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([own[r] for r in who], pa.string()), pa.array(n[at[who]]),
                             pa.array(other, pa.string())], ["word", "n", "other"])

        found = dealt.mapInArrow(probe, "word string, n long, other string")
        parts.append(found if slices == 1 else staged(found, "spelling_positives"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def near_pairs(words: DataFrame, most_bytes: int = blocked_bloom.MOST_BYTES) -> DataFrame:
    """Stored (word, n, other, other_n): each pair of near words once."""
    known = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    return staged(candidates(words, most_bytes).join(known, "other").select("word", "n", "other", "other_n"), "spelling_pairs")


def roots(links: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(word, root) from (word, form): the end of each chain, by pointer jumping."""
    now = staged(links.select("word", F.col("form").alias("root")), "spelling_links")
    for _ in range(most_rounds):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = staged(now.join(ahead, "root", "left")
                      .select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")),
                      "spelling_links")
        now = step.select("word", "root")
        if not step.agg(F.coalesce(F.bool_or("moved"), F.lit(False)).alias("m")).first()["m"]:
            return now
    raise RuntimeError(f"chains did not end in {most_rounds} rounds")


def spelling_variants(docs: DataFrame, most_bytes: int = blocked_bloom.MOST_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every frequent word."""
    words = vocabulary(docs)
    pairs = near_pairs(words, most_bytes)
    sides = (pairs.select("word", "other", "other_n")
             .union(pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n"))))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other")))
    near = sides.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("b"))
    strong = F.col("n_near").isNotNull() & (-F.col("b.less") >= DOMINANCE * F.col("n"))
    forms = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("b.other")).alias("form"), F.when(strong, -F.col("b.less")).alias("form_n")), "spelling_forms")
    ends = roots(forms.where("form is not null"))
    return (forms.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
