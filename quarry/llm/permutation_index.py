"""Nearest neighbours by a permutation index.

1. Equal vectors collapse to one row that keeps their smallest ids (one more
   than the neighbours asked for), so a group of copies costs one vector.
2. A bounded sample (``SAMPLE`` vectors, by a hash of the id) gives the pivots
   and fits two numbers by brute force inside the sample: how many pivot lists a
   query visits, and up to which footrule distance candidates are reranked. Both
   are the smallest that reach the wanted recall there; in the larger table the
   neighbours lie closer, so recall is higher.
3. Every vector is represented by its ``PREFIX`` nearest pivots in order and
   posted in the inverted files of the first ``POSTS``. A query visits the files
   of its nearest pivots. A file longer than ``CELL`` is dealt into chunks, many
   queries into blocks; a tile (file, chunk, block) is bounded.
4. In a tile candidates are ranked by footrule distance of the pivot orders,
   those within the fitted bound are reranked by exact Euclidean distance in
   double precision, and the best of each query leave the tile. A vector posted
   in several visited files is judged in the first of them only.
5. The best of all tiles are merged and expanded to ids.

A query with fewer neighbours than there are candidates visits all files.

Defined results: vectors that are null, zero, of another length than the
commonest (the longer on ties), or hold null or non-finite components take no
part, nor do null ids; rows repeated with their id count once; an id with two
vectors is two candidates and, as a query, is searched by both; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import staged

SAMPLE = 4096
PREFIX = 32
POSTS = 4
CELL = 8192
BLOCK = 1024
RECALL = 0.97


@dataclass(frozen=True)
class Index:
    pivots: np.ndarray
    visits: int
    footrule: float


def valid_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Distinct (id, v) that take part."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    good = (rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
            .where(F.col("id").isNotNull() & v.isNotNull()).where(~bad & some))
    size = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return good.where(F.size("v") == (size["n"] if size else 0)).distinct()


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """Ordered numbers of the ``k`` nearest pivots of each row, ties to the smaller number."""
    out = np.empty((len(x), min(k, len(pivots))), np.int32)
    for a in range(0, len(x), 2048):
        d = (pivots * pivots).sum(1)[None, :] - 2 * x[a:a + 2048] @ pivots.T
        out[a:a + 2048] = np.argsort(d, axis=1, kind="stable")[:, :out.shape[1]]
    return out


def footrule(query: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Sum over the query's pivots of the rank differences; ``ranks`` (rows x pivots)
    has the place of each pivot in a candidate's order, ``PREFIX`` if it isn't there."""
    return np.abs(ranks[:, query].astype(np.int32) - np.arange(len(query), dtype=np.int32)).sum(1)


def rank_table(orders: np.ndarray, pivots: int) -> np.ndarray:
    out = np.full((len(orders), pivots), PREFIX, np.uint8)
    np.put_along_axis(out, orders, np.arange(orders.shape[1], dtype=np.uint8)[None, :].repeat(len(orders), 0), 1)
    return out


def fit(sample: np.ndarray, n: int, k: int, recall: float = RECALL) -> Index:
    """Pivots, visits and footrule bound from the sample (rows in hash order)."""
    m = int(max(1, min(256, len(sample), 2 * np.sqrt(n))))
    pivots = sample[:m]
    orders = nearest_pivots(sample, pivots, m)
    ranks = rank_table(orders[:, :PREFIX], m)
    asked = np.arange(len(sample))[-256:]
    need, far = [], []
    for q in asked:
        d = ((sample - sample[q]) ** 2).sum(1)
        d[q] = np.inf
        best = np.argsort(d, kind="stable")[:min(k, len(sample) - 1)]
        place = np.empty(m, np.int64)
        place[orders[q]] = np.arange(m)
        need += place[orders[best, :POSTS]].min(1).tolist()  # visits after which it is met
        far += footrule(orders[q, :PREFIX], ranks[best]).tolist()
    if not need:
        return Index(pivots, m, np.inf)
    share = 1 - (1 - recall) / 2  # what may be missed is split between the two
    return Index(pivots, min(m, 1 + int(np.quantile(need, share, method="higher"))),
                 float(np.quantile(far, share, method="higher")))


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def _posted(rows: DataFrame, index: Index, lists: int, side: int) -> DataFrame:
    """(pivot, side, id, order, v): a row in each of the first ``lists`` files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1))
            order = nearest_pivots(x, index.pivots, max(PREFIX, lists))
            use = order[:, :lists]
            k, at = use.shape[1], np.repeat(np.arange(len(x)), use.shape[1])
            short = [o.tobytes() for o in order[:, :PREFIX].astype(np.int16)]
            raw = [v.tobytes() for v in x]
            # queries carry all files they visit, candidates the few they are posted in
            files = [o.tobytes() for o in use.astype(np.int16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(use.reshape(-1)), pa.array(np.full(len(at), side, np.int32)),
                 b.column(0).take(pa.array(at)), pa.array([short[i] for i in at], pa.binary()),
                 pa.array([files[i] for i in at], pa.binary()), pa.array([raw[i] for i in at], pa.binary())],
                ["pivot", "side", "id", "order", "files", "v"])

    return rows.select("id", "v").mapInArrow(
        run, "pivot int, side int, id long, order binary, files binary, v binary")


def search(candidates: DataFrame, queries: DataFrame, index: Index, k: int) -> DataFrame:
    """(query, id, score): the ``k`` best of each tile for each query; both inputs (id, v) of distinct vectors."""
    m = len(index.pivots)
    post = min(POSTS, m)
    rows = staged(_posted(candidates, index, post, 0).union(_posted(queries, index, index.visits, 1)), "ann_posts")
    # at most two numbers a pivot
    size = {(r["pivot"], r["side"]): r["count"] for r in rows.groupBy("pivot", "side").count().collect()}

    def chunks(side: int, each: int) -> Column:
        return F.get(F.array(*[F.lit(max(1, -(-size.get((p, side), 0) // each))) for p in range(m)]), F.col("pivot"))

    cells, blocks = chunks(0, int(CELL * 0.9)), chunks(1, int(BLOCK * 0.9))
    mine = F.when(F.col("side") == 0, cells).otherwise(blocks)
    other = F.when(F.col("side") == 0, blocks).otherwise(cells)
    own = F.pmod(F.xxhash64("id", "side"), mine).cast("int")
    both = {p for p, s in size if s == 0 and (p, 1) in size}
    dealt = (rows.where(F.col("pivot").isin(sorted(both)))
             .select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), other - 1)).alias("x"))
             .select("pivot", F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("x")).alias("cell"),
                     F.when(F.col("side") == 0, F.col("x")).otherwise(F.col("own")).alias("block"),
                     "side", "id", "order", "files", "v"))

    def tile(at: tuple, parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        t = pa.Table.from_batches(parts)
        side = t.column("side").to_numpy()
        ids = t.column("id").to_numpy()
        cut = int((side == 0).sum())  # sorted by side
        if not cut or cut == len(side):
            return None

        def stack(name: str, kind) -> np.ndarray:
            raw = t.column(name).to_pylist()
            return (np.frombuffer(b"".join(raw[:cut]), kind).reshape(cut, -1),
                    np.frombuffer(b"".join(raw[cut:]), kind).reshape(len(raw) - cut, -1))

        x, q = stack("v", np.float64)
        ox, oq = stack("order", np.int16)
        posted, visited = stack("files", np.int16)
        ranks = rank_table(ox.astype(np.int64), m)
        out = []
        seen = np.zeros(m, bool)
        for i in range(len(q)):
            seen[:] = False
            seen[visited[i]] = True
            # the first of its files that the query visits
            first = posted[np.arange(cut), seen[posted].argmax(1)] == at[0]
            near = np.flatnonzero(first)
            near = near[footrule(oq[i], ranks[near]) <= index.footrule]
            if len(near):
                d = np.sqrt(((x[near] - q[i]) ** 2).sum(1))
                best = np.lexsort((ids[near], d))[:k]
                out.append((np.full(len(best), ids[cut + i]), ids[near[best]], d[best]))
        if not out:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                          ["query", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, parts = None, []
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(i).to_numpy() for i in range(3)])
            new = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), b.num_rows]
            for a, e in zip(new, new[1:], strict=False):
                at = tuple(keys[:, a].tolist())
                if at != head:
                    if parts and (found := tile(head, parts)) is not None:
                        yield found
                    head, parts = at, []
                parts.append(b.slice(a, e - a))
        if parts and (found := tile(head, parts)) is not None:
            yield found

    order = ["pivot", "cell", "block"]
    return (dealt.repartition(*order).sortWithinPartitions(*order, "side")
            .mapInArrow(run, "query long, id long, score double"))


def _best(rows: DataFrame, by: str, order: list[str], k: int) -> DataFrame:
    """Row numbers up to ``k``; Spark cuts each task's groups before the shuffle."""
    w = Window.partitionBy(by).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def neighbours(rows: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id",
               vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score for the ids divisible by ``every``."""
    valid = staged(valid_vectors(rows, id_col, vec_col), "ann_valid")
    # the k + 1 smallest ids of each distinct vector
    w = Window.partitionBy("v").orderBy("id")
    reps = staged(valid.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k + 1)
                  .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
                  .select(F.get("ids", F.lit(0)).alias("id"), "ids", "v"), "ann_distinct")
    n = reps.count()
    share = F.shiftrightunsigned(F.xxhash64("id", F.lit("sample")), 11) / F.lit(float(1 << 53))
    taken = reps.where(share < min(1.0, SAMPLE / max(1, n))).select("id", "v").toArrow()
    if not taken.num_rows:
        taken = reps.select("id", "v").limit(1).toArrow()
    asked = valid.where(F.pmod("id", F.lit(every)) == 0)
    found = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not taken.num_rows:
        return found
    order = np.random.default_rng(7).permutation(taken.num_rows)
    ids = taken.column("id").to_numpy()
    sample = _matrix(taken.column("v").combine_chunks())[np.argsort(ids, kind="stable")][order]
    index = fit(sample, n, k)
    # query ids and the representative of their vector
    who = staged(asked.join(reps.select(F.col("id").alias("rep"), "v"), "v").select("id", "rep", "v"), "ann_queries")
    queries = who.select(F.col("rep").alias("id"), "v").distinct()
    best = staged(_best(search(reps, queries, index, k + 1), "query", ["score", "id"], k + 1).drop("rank"), "ann_best")
    near = _expanded(best, reps, k)
    total = valid.count()
    full = near.groupBy("query").count().where(F.col("count") >= min(k + 1, total))
    short = staged(queries.join(full.select(F.col("query").alias("id")), "id", "left_anti"), "ann_short")
    if short.limit(1).count():
        all_files = Index(index.pivots, len(index.pivots), np.inf)
        again = _best(search(reps, short, all_files, k + 1), "query", ["score", "id"], k + 1).drop("rank")
        near = near.join(short.select(F.col("id").alias("query")), "query", "left_anti").union(
            _expanded(again, reps, k))
    joined = (who.select(F.col("id").alias("query_id"), F.col("rep").alias("query"))
              .join(near, "query").where("vec_id <> query_id"))
    return (_best(joined, "query_id", ["score", "vec_id"], k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _expanded(best: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """(query, vec_id, score) of the k + 1 nearest ids, the query's own among them."""
    rows = best.join(reps.select("id", "ids"), "id").select("query", F.explode("ids").alias("vec_id"), "score")
    return _best(rows, "query", ["score", "vec_id"], k + 1).drop("rank")
