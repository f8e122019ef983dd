"""Benchmark decontamination by winnowing.

A text is normalised (A-Z lowered, its words joined by one blank). Item words make
windows of ``WINDOW`` words; an item of fewer words is one window of its length.

1. For windows of n words, k-grams of ``(n + 1) // 2`` words are hashed, and of the
   ``n - k + 1`` k-grams of every window the smallest hash is kept (the leftmost of
   equal ones): a fingerprint. A span of n words that a document shares with an item
   holds the same k-grams on both sides, so both keep the same one: no shared window
   is missed.
2. The items' fingerprints and window hashes fill blocked Bloom filters of at most
   ``MOST_BYTES``, which are broadcast. Document fingerprints are joined with them in
   the tasks; a hit is extended to the windows around it that hold its k-gram, and
   those that may be windows of items become runs (spans of words that overlap).
   Clean documents leave nothing to shuffle.
3. Runs are mostly the same text over and over: distinct runs only are cut into
   windows and joined with the items' windows by their words, which removes what the
   filters found wrongly. That join fixes the hit words and the items of a run.
4. Windows that occur in the same items share an item set; a document's sets are
   gathered over its runs. Documents of the same list of runs share one result.

Nothing grows with the square of a group: hot passages meet in partial aggregates
over run texts, and every join has plain exchanges that Spark can split.

Defined results: null and empty texts have no words, such items no window; repeated
documents get the same result each; repeated rows of an item count once; a null
item_id has no windows; empty tables give no rows or clean documents; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import blocked_bloom
from quarry.llm.common import staged, text_of

WINDOW = 10
#: Bytes of text that a task works on at once (a longer text by itself).
PIECE = 1 << 19
_BASE = 0x9E3779B97F4A7C15
#: UTF-8 bytes: A-Z lowered; letters, digits and what isn't ASCII kept; everything else a blank.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_PRINT, _WHOLE = 0, 1  # shards of a window length: 2 * length + one of these


def normal(text: str) -> bytes:
    """The words, joined by one blank."""
    return b" ".join(text.encode().translate(_WORDS).split())


class Grams:
    """Hashes of word spans of several normalised texts, by one prefix sum over their bytes."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)  # every text ends with a line feed
        self.raw = raw
        cut = np.flatnonzero((raw == 32) | (raw == 10))  # one after each word; for an empty text, after nothing
        start = np.concatenate([[0], cut[:-1] + 1]).astype(np.int64) if len(cut) else np.zeros(0, np.int64)
        real = cut > start
        self.doc = np.searchsorted(np.flatnonzero(raw == 10), cut)[real]  # text of each word
        self.start, self.end = start[real], cut[real].astype(np.int64)
        self.n_words = np.bincount(self.doc, minlength=len(texts))
        power = np.full(len(raw) + 1, np.uint64(_BASE))
        power[0] = 1
        np.cumprod(power, out=power)
        self.sum = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)])
        back = np.full(len(raw) + 1, np.uint64(pow(_BASE, -1, 1 << 64)))
        back[0] = 1
        self.back = np.cumprod(back)

    def spans(self, length: int) -> np.ndarray:
        """First words of all spans of ``length`` words of one text."""
        first = np.arange(max(0, len(self.doc) - length + 1))
        return first[self.doc[first] == self.doc[first + length - 1]]

    def hashes(self, first: np.ndarray, length: int) -> np.ndarray:
        a, e = self.start[first], self.end[first + length - 1]
        return blocked_bloom.mixed((self.sum[e] - self.sum[a]) * self.back[a])

    def words(self, first: int, length: int) -> bytes:
        return self.raw[self.start[first]:self.end[first + length - 1]].tobytes()


def prints(grams: Grams, windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the k-gram that each window keeps."""
    k = (length + 1) // 2
    if not len(windows):
        return windows, np.zeros(0, np.uint64)
    h = np.full(len(grams.doc), np.uint64(0xFFFFFFFFFFFFFFFF))
    at = grams.spans(k)
    h[at] = grams.hashes(at, k)
    best, where = h[windows].copy(), windows.copy()
    for i in range(1, length - k + 1):
        other = h[windows + i]
        less = other < best
        best[less], where[less] = other[less], windows[less] + i
    return where, best


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Stored (item_id string, length, h, print, window): the distinct windows of each item; hashes as signed longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, texts = batch.column(0).to_pylist(), [normal(t) for t in batch.column(1).to_pylist()]
            for a, e in _pieces(texts):
                grams = Grams(texts[a:e])
                short = grams.n_words[grams.doc] < WINDOW
                for length in sorted({WINDOW, *grams.n_words[(grams.n_words > 0) & (grams.n_words < WINDOW)].tolist()}):
                    at = grams.spans(length)
                    at = at[~short[at]] if length == WINDOW else at[grams.n_words[grams.doc[at]] == length]
                    if len(at):
                        _, best = prints(grams, at, length)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([who[a + d] for d in grams.doc[at].tolist()], pa.string()),
                             pa.array(np.full(len(at), length, np.int32)), pa.array(grams.hashes(at, length).view(np.int64)),
                             pa.array(best.view(np.int64)),
                             pa.array([grams.words(i, length).decode() for i in at.tolist()], pa.string())],
                            ["item_id", "length", "h", "print", "window"])

    rows = (benchmark.where(F.col("item_id").isNotNull())
            .select(F.col("item_id").cast("string").alias("item_id"), text_of().alias("text")))
    found = rows.mapInArrow(run, "item_id string, length int, h long, print long, window string")
    return staged(found.dropDuplicates(["item_id", "window"]), "item_windows")


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= PIECE:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _filters(windows: DataFrame) -> tuple[list[int], blocked_bloom.Shape, Broadcast]:
    """Window lengths in use (10 at most), and the filters of fingerprints and windows of each."""
    keys = (windows.select((F.col("length") * 2 + _PRINT).alias("shard"), F.col("print").alias("h"))
            .union(windows.select(F.col("length") * 2 + _WHOLE, "h")).distinct())
    count = {r["shard"]: r["c"] for r in keys.groupBy("shard").agg(F.count("*").alias("c")).collect()}
    shape = blocked_bloom.Shape(count)
    sent = windows.sparkSession.sparkContext.broadcast(blocked_bloom.fill(keys, shape))
    return sorted({s // 2 for s in count}), shape, sent


def extended(grams: Grams, lengths: list[int], shape: blocked_bloom.Shape, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, word after the last) of the runs: hits of fingerprints, extended to windows."""
    first, after = [], []
    for length in lengths:
        at = grams.spans(length)
        where, best = prints(grams, at, length)
        new = np.flatnonzero(np.diff(where, prepend=-1))  # a k-gram that windows in a row keep is one fingerprint
        met = blocked_bloom.found(bits, shape, 2 * length + _PRINT, best[new])
        hit = np.zeros(len(new), bool)
        hit[met] = True
        around = at[hit[np.cumsum(np.bincount(new, minlength=len(at))) - 1]] if len(new) else at
        mine = around[blocked_bloom.found(bits, shape, 2 * length + _WHOLE, grams.hashes(around, length))]
        first.append(mine)
        after.append(mine + length)
    a, e = np.concatenate([np.zeros(0, np.int64), *first]), np.concatenate([np.zeros(0, np.int64), *after])
    if not len(a):
        return a, e
    order = np.lexsort((e, a))
    a, e = a[order], e[order]
    reach = np.maximum.accumulate(e)
    new = np.concatenate([[True], a[1:] >= reach[:-1]])
    return a[new], np.maximum.reduceat(e, np.flatnonzero(new))


def document_runs(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Stored (doc_id, n_words, runs): texts of the spans that may hold windows, null where there are none."""
    lengths, shape, sent = _filters(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            texts = [normal(t) for t in batch.column(1).to_pylist()]
            for a, e in _pieces(texts):
                grams = Grams(texts[a:e])
                runs: list[list[str] | None] = [None] * (e - a)
                for i, j in zip(*(x.tolist() for x in extended(grams, lengths, shape, bits)), strict=True):
                    d = int(grams.doc[i])
                    runs[d] = [*(runs[d] or []), grams.words(i, j - i).decode()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:e], pa.array(grams.n_words, pa.int64()), pa.array(runs, pa.list_(pa.string()))],
                    ["doc_id", "n_words", "runs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    found = rows.mapInArrow(run, "doc_id long, n_words long, runs array<string>")
    key = F.when(F.col("runs").isNotNull(), F.sha2(F.array_join("runs", "\n"), 256))
    return staged(found.withColumn("key", key), "document_runs")


def _cut(runs: DataFrame, lengths: list[int]) -> DataFrame:
    """(run, at, length, window): all windows of the distinct run texts."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in batch.column(0).to_pylist():
                words = run.split(" ")
                for n in lengths:
                    at = range(len(words) - n + 1)
                    if at:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([run] * len(at)), pa.array(at, pa.int32()), pa.array([n] * len(at), pa.int32()),
                             pa.array([" ".join(words[i:i + n]) for i in at])], ["run", "at", "length", "window"])

    return runs.mapInArrow(cut, "run string, at int, length int, window string")


def _covered(spans: F.Column) -> F.Column:
    """Words covered by the (at, length) of a run in ascending order."""
    step = F.aggregate(
        spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda x, s: F.struct((x["n"] + F.greatest(F.lit(0), s["at"] + s["length"] - F.greatest(x["reach"], s["at"]))).alias("n"),
                              F.greatest(x["reach"], s["at"] + s["length"]).alias("reach")))
    return step["n"].cast("long")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    windows = item_windows(benchmark)
    found = document_runs(docs, windows)
    lengths = [r["length"] for r in windows.select("length").distinct().collect()]  # 10 at most
    # item sets: the items of a window, shared by all windows of the same items
    sets = windows.groupBy("window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    sets = staged(sets.select("window", F.sha2(F.array_join("items", ","), 256).alias("set"), "items"), "item_sets")
    runs = found.where("key is not null").select(F.explode("runs").alias("run")).distinct()
    at = _cut(runs, lengths).join(sets.select("window", "set"), "window")
    verdict = staged(at.groupBy("run").agg(
        F.sort_array(F.collect_set(F.struct("at", "length"))).alias("spans"), F.collect_set("set").alias("sets"))
        .select("run", _covered(F.col("spans")).alias("n_hit"), "sets"), "run_verdicts")
    # one result for each list of runs
    lists = found.where("key is not null").select("key", "runs").dropDuplicates(["key"])
    of_list = lists.select("key", F.explode("runs").alias("run")).join(verdict, "run")
    hit = of_list.groupBy("key").agg(F.sum("n_hit").alias("n_hit"),
                                     F.array_sort(F.array_distinct(F.flatten(F.collect_list("sets")))).alias("sets"))
    hit = staged(hit.withColumn("sets_key", F.sha2(F.array_join("sets", ","), 256)), "list_verdicts")
    names = (hit.select("sets_key", "sets").dropDuplicates(["sets_key"]).select("sets_key", F.explode("sets").alias("set"))
             .join(sets.select("set", "items").dropDuplicates(["set"]), "set"))
    names = names.select("sets_key", F.explode("items").alias("item_id")).distinct()
    names = names.groupBy("sets_key").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    digest = names.select("sets_key", F.size("items").cast("long").alias("n_items"),
                          F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    result = staged(hit.join(digest, "sets_key").select("key", "n_hit", "n_items", "items_sha256"), "list_results")
    none = F.lit(0).cast("long")
    out = lambda n_hit, n_items, sha: [
        F.col("doc_id"), F.col("n_words"), F.coalesce(n_hit, none).alias("n_hit"), F.coalesce(n_items, none).alias("n_items"),
        F.coalesce(sha, F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.coalesce(n_hit, none) > 0).alias("contaminated")]
    marked = found.where("key is not null").join(result, "key", "left")
    return (found.where("key is null").select(*out(none, none, F.lit(None).cast("string")))
            .union(marked.select(*out(F.col("n_hit"), F.col("n_items"), F.col("items_sha256")))))
