"""Incremental loads: each file once, each key once, broken records aside."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.tables import insert_ignore


def load_new_files(spark: SparkSession, source: str, target: str, ledger: str, schema: str, keys: Sequence[str], order: Sequence[Column], fmt: str = "parquet", clean: Callable[[DataFrame], DataFrame] | None = None, options: dict[str, str] | None = None) -> None:
    """Load the files of a folder that the ledger doesn't know yet; then stop.

    The ledger is the checkpoint of a file stream: running this again loads only what is new. Rows whose key the target
    has are ignored, so a batch that is run again after a failure adds nothing twice. Target is a folder of batches.
    """

    def put(batch: DataFrame, number: int) -> None:
        rows = clean(batch) if clean else batch
        have = rows.limit(0)  # the first batch finds no target
        if _exists(spark, target):
            have = spark.read.schema(rows.schema).parquet(f"{target}/batch=*")
            have = have.where(~F.col("_metadata.file_path").contains(f"/batch={number}/")).select(*rows.columns)
        new = insert_ignore(rows.limit(0), rows.join(have.select(*keys).distinct(), list(keys), "left_anti"), keys, order)
        new.write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(source)
    stream.writeStream.foreachBatch(put).option("checkpointLocation", ledger).trigger(availableNow=True).start().awaitTermination()


def _exists(spark: SparkSession, folder: str) -> bool:
    """Whether the folder holds a batch; any failure to look is an error."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch=*")
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or [])


def loaded(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/batch=*")


def set_aside(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows, broken rows) by a column that says what is wrong with a row."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def choose_range(spark: SparkSession, table: str, everything: tuple, recent: tuple) -> tuple:
    """The range to fetch: everything for a table that doesn't exist, else what is recent."""
    return recent if spark.catalog.tableExists(table) else everything


def event_windows(events: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """Count and sum of value per window and keys, with late rows dropped after `late`; for streams and tables alike."""
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    timed = timed.withWatermark(time, late) if timed.isStreaming else timed
    return timed.groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")
