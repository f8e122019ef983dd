"""Type-1 dimensions in bucketed files that a merge rewrites only where it must.

Rows lie in ``buckets`` folders by a hash of the natural key. A merge compares the
batch with the buckets it can touch, and writes a new folder for those buckets in
which a row is new or has changed; all others stay the files they were. A
:class:`StoredDimension` names the folder of each bucket, so the state before and
after a merge can both be read, and a version is a list of paths.

The driver holds one path a bucket. The number of buckets grows with the dimension
(it doubles when buckets get larger than ``ROWS_A_BUCKET``, which rewrites them).
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.operators.modeling import assign_surrogate_keys
from quarry.operators.quality import require_key
from quarry.session import scratch_path
from quarry.sources.files import stored

ROWS_A_BUCKET = 500_000
LEAST_BUCKETS = 8
LOADED_AT = "loaded_at"


@dataclass(frozen=True)
class StoredDimension:
    natural_key: str
    key: str
    attrs: list[str]
    schema: str  # as JSON
    buckets: int
    rows: int
    max_key: int
    paths: dict[str, str] = field(default_factory=dict)  # bucket -> folder; buckets without rows have none

    def read(self, spark: SparkSession, buckets: list[int] | None = None) -> DataFrame:
        """The rows, or those of some buckets."""
        schema = StructType.fromJson(json.loads(self.schema))
        paths = [p for b, p in self.paths.items() if buckets is None or int(b) in buckets]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def manifest(self) -> dict:
        return asdict(self)


def bucket_of(natural_key: str, buckets: int) -> Column:
    """Doubling ``buckets`` splits each bucket in two."""
    return F.pmod(F.xxhash64(natural_key), F.lit(buckets)).cast("int")


def _wanted_buckets(rows: int, least: int) -> int:
    n = least
    while n * ROWS_A_BUCKET < rows:
        n *= 2
    return n


def _write(rows: DataFrame, location: str, natural_key: str, buckets: int, written: list[int]) -> dict[str, str]:
    """Folders of the ``written`` buckets."""
    (rows.withColumn("bucket", bucket_of(natural_key, buckets)).repartition(max(1, len(written)), "bucket")
     .write.partitionBy("bucket").parquet(location))
    return {str(b): f"{location}/bucket={b}" for b in written}


def create(incoming: DataFrame, natural_key: str, key: str, attrs: list[str], location: str,
           now: Column | None = None, buckets: int = LEAST_BUCKETS, checked: bool = False) -> StoredDimension:
    """A first load: rows numbered in natural-key order.

    ``incoming`` should be stored, it is read more than once; ``checked``: its natural
    key is known to be unique and not null.
    """
    if not checked:
        require_key(incoming, natural_key, "incoming")
    now = now if now is not None else F.current_timestamp()
    keyed = (assign_surrogate_keys(incoming.select(natural_key, *attrs), natural_key, key)
             .withColumn(LOADED_AT, now).select(key, natural_key, *attrs, LOADED_AT))
    # one row a bucket
    sizes = {r["b"]: r["count"] for r in incoming.groupBy(bucket_of(natural_key, buckets).alias("b")).count().collect()}
    rows = sum(sizes.values())
    wanted = _wanted_buckets(rows, buckets)
    used = sorted(sizes) if wanted == buckets else _buckets_of(incoming, natural_key, wanted)
    buckets = wanted
    return StoredDimension(natural_key, key, attrs, keyed.schema.json(), buckets, rows, rows,
                           _write(keyed, location, natural_key, buckets, used))


def _buckets_of(rows: DataFrame, natural_key: str, buckets: int) -> list[int]:
    """Buckets with rows: at most ``buckets`` numbers."""
    return sorted(r["b"] for r in rows.select(bucket_of(natural_key, buckets).alias("b")).distinct().collect())


def merge(dim: StoredDimension, incoming: DataFrame, location: str, now: Column | None = None,
          checked: bool = False, keys_in_order: bool = True) -> tuple[StoredDimension, list[int]]:
    """(dimension after the batch, buckets rewritten below ``location``).

    * natural key in both: key and load time stay, every attribute is the batch's (a null
      overwrites); rows that don't change aren't news;
    * only in the dimension: the row stays;
    * only in the batch: a key after the largest, in natural-key order (or, without
      ``keys_in_order``, in the order the new rows are stored in: no sort).

    ``incoming`` should be stored; its natural key must be unique and not null.
    """
    spark, nat, attrs = incoming.sparkSession, dim.natural_key, dim.attrs
    if not checked:
        require_key(incoming, nat, "incoming")
    now = now if now is not None else F.current_timestamp()
    kinds = {f.name: f.dataType for f in StructType.fromJson(json.loads(dim.schema)).fields}
    batch = incoming.select(*[F.col(c).cast(kinds[c]).alias(c) for c in [nat, *attrs]])
    reach = _buckets_of(batch, nat, dim.buckets)
    old = dim.read(spark, reach).select(F.col(nat).alias("_q_id"), F.col(dim.key).alias("_q_key"),
                                        F.col(LOADED_AT).alias("_q_at"), *[F.col(a).alias(f"_q_o_{a}") for a in attrs])
    same = F.col("_q_key").isNotNull()
    for a in attrs:
        same = same & F.col(a).eqNullSafe(F.col(f"_q_o_{a}"))
    news = stored(batch.join(old, F.col(nat) == F.col("_q_id"), "left").where(~same).select("_q_key", nat, *attrs, "_q_at"),
                  scratch_path(spark, f"{dim.key}_news"))
    count = news.agg(F.count(F.lit(1)).alias("n"), F.count("_q_key").alias("old")).first()
    if not count["n"]:
        return dim, []
    fresh_rows = count["n"] - count["old"]
    rows = dim.rows + fresh_rows
    buckets = _wanted_buckets(rows, dim.buckets)
    touched = _buckets_of(news, nat, buckets)
    written = touched if buckets == dim.buckets else list(range(buckets))
    columns = [dim.key, nat, *attrs, LOADED_AT]
    kept = (dim.read(spark, written if buckets == dim.buckets else None)
            .join(news.select(nat), nat, "left_anti").select(*columns))
    changed = news.where("_q_key is not null").select(F.col("_q_key").alias(dim.key), nat, *attrs, F.col("_q_at").alias(LOADED_AT))
    after = kept.unionByName(changed)
    if fresh_rows:
        fresh = assign_surrogate_keys(news.where("_q_key is null").select(nat, *attrs), nat, dim.key, start_after=dim.max_key,
                                      in_order=keys_in_order)
        after = after.unionByName(fresh.withColumn(LOADED_AT, now).select(*columns))
    if buckets != dim.buckets:
        after = stored(after, scratch_path(spark, f"{dim.key}_split"))
        written = _buckets_of(after, nat, buckets)
    paths = _write(after, location, nat, buckets, written)
    if buckets == dim.buckets:
        paths = dim.paths | paths
    return StoredDimension(nat, dim.key, attrs, dim.schema, buckets, rows, dim.max_key + fresh_rows, paths), written


def from_manifest(manifest: dict) -> StoredDimension:
    return StoredDimension(**manifest)

