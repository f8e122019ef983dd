"""The raw -> silver order ingest, run incrementally over newly landed CSV files.

Same operator as the batch job (:func:`quarry.operators.cleaning.tag_orders`),
driven by Structured Streaming: a file source with a declared schema, one
micro-batch per trigger, and ``foreachBatch`` writing each batch to its own
``batch_id=<n>`` folder with overwrite. A retried batch rewrites the same folder,
so output is exactly-once with the stream checkpoint (kept in the shared
checkpoint folder) recording which files were consumed. Readers see a batch only
once it is whole: they read the folders that hold Spark's ``_SUCCESS`` mark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.cleaning import tag_orders
from quarry.sources.files import CORRUPT_RECORD, RAW_SCHEMAS, stored


def start_order_ingest(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint_dir: str,
                       customers: DataFrame, products: DataFrame, stores: DataFrame,
                       files_per_batch: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the stream; tagged rows land in ``out_dir/batch_id=<n>/rejection_reason=...``."""
    # micro-batches join stored key tables: the dimensions are cleaned once
    keys = [stored(df, f"{out_dir}_keys/{i}") for i, df in enumerate((customers, products, stores))]
    wide = T.StructType([*RAW_SCHEMAS["orders"].fields, T.StructField(CORRUPT_RECORD, T.StringType())])
    reader = (spark.readStream.schema(wide).option("header", True)
              .option("columnNameOfCorruptRecord", CORRUPT_RECORD))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    raw = reader.csv(landing_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        tagged = tag_orders(batch, *keys)
        (tagged.write.mode("overwrite").partitionBy("rejection_reason")
         .parquet(f"{out_dir}/batch_id={batch_id}"))

    w = raw.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_ingested(spark: SparkSession, out_dir: str) -> DataFrame:
    """All whole batches written so far (the tagged columns and ``batch_id``)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    schema = T.StructType([f if f.name != "order_date" else T.StructField("order_date", T.DateType())
                           for f in RAW_SCHEMAS["orders"].fields]
                          + [T.StructField("rejection_reason", T.StringType())])
    whole = [f.getPath() for f in (fs.listStatus(path) if fs.exists(path) else [])
             if f.getPath().getName().startswith("batch_id=")
             and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    if not whole:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch_id", T.IntegerType())]))
    return (spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.IntegerType())]))
            .option("basePath", out_dir).parquet(*[p.toString() for p in whole]))
