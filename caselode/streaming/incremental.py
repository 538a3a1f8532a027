"""Incremental processing: only ids not yet recorded (INC-1, INC-2)."""

import threading
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def unrecorded(new: DataFrame, recorded: DataFrame, id_col: str = "case_id") -> DataFrame:
    """Rows whose id has no record yet (INC-1)."""
    return new.join(recorded.select(id_col), id_col, "left_anti")


def _recorded_before(spark: SparkSession, path: str, schema, stream: str, batch: int) -> DataFrame:
    schema = f"{schema}, stream string, batch_id long"
    try:
        done = spark.read.schema(schema).parquet(path)
    except AnalysisException:  # nothing was written yet
        return spark.createDataFrame([], schema)
    return done.filter((F.col("stream") != stream) | (F.col("batch_id") != batch))


def _first_of_each(batch: DataFrame, id_col: str) -> DataFrame:
    """One row per id: the first in the order of all columns, so that a replay keeps the same."""
    order = Window.partitionBy(id_col).orderBy(*(c for c in batch.columns if c != id_col), id_col)
    return batch.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def run_available(
    spark: SparkSession, source: str, schema: str, target: str,
    process: Callable[[DataFrame], DataFrame] = lambda df: df,
    id_col: str = "case_id", checkpoint: str | None = None,
) -> None:
    """Process the files that arrived since the last run and append the results.

    Each micro-batch overwrites its own partition, named by the stream's id and the batch, so a
    batch that is replayed after a failure replaces itself and adds nothing (INC-2).  The
    state lies beside the results unless ``checkpoint`` names a folder.  A run without its
    old state is another stream: it leaves what others recorded and skips their ids.
    """
    checkpoint = checkpoint or f"{target}/_state"
    started, known = threading.Event(), []

    def record(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        started.wait()
        stream = known[0]
        ids = f"{id_col} {batch.schema[id_col].dataType.simpleString()}"
        done = _recorded_before(session, target, ids, stream, batch_id)
        fresh = unrecorded(_first_of_each(batch, id_col), done, id_col)
        path = f"{target}/stream={stream}/batch_id={batch_id}"
        process(fresh).write.mode("overwrite").parquet(path)

    rows = spark.readStream.schema(schema).parquet(source)
    run = (
        rows.writeStream.foreachBatch(record)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    known.append(str(run.id))
    started.set()
    run.awaitTermination()


def forget_last_commit(spark: SparkSession, checkpoint: str) -> int | None:
    """Make the next run repeat the last batch, as after a failure before its commit; the batch's number."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    store = folder.getFileSystem(conf)
    numbers = [int(f.getPath().getName()) for f in store.listStatus(folder) if f.getPath().getName().isdigit()]
    if not numbers:
        return None
    last = max(numbers)
    for name in (str(last), f".{last}.crc"):
        store.delete(jvm.org.apache.hadoop.fs.Path(folder, name), False)
    return last
