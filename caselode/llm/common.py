"""What the operators share: reading a table, and passing Arrow batches through a function."""

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns that an operator reads, under fixed names."""
    return df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))


def give_back_memory() -> None:
    """Return what a worker has freed to the system; workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def numbered_copies(df: DataFrame, copies: str, run=4_096) -> DataFrame:
    """A row per copy of each row of `df`, with `number` from 0 to `copies` - 1 in its place.

    Rows of many copies are cut into runs, which are spread, so no task makes more than a run of one row."""
    step = F.lit(run).cast("long")
    cut = df.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, step)))
    last = F.least(F.col(copies), F.col("number") + run) - 1
    spread = cut.withColumn("_last", last).repartition(F.xxhash64(*cut.columns))
    return spread.withColumn("number", F.explode(F.sequence("number", "_last"))).drop("_last", copies)


def map_batches(df: DataFrame, function, schema: str | T.StructType) -> DataFrame:
    """`function` takes a record batch and yields dicts of columns in the order of `schema`."""
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(fields)

    def run(batches):
        for batch in batches:
            give_back_memory()  # of the batch before
            if batch.num_rows:
                for columns in function(batch):
                    yield pa.RecordBatch.from_arrays(
                        [
                            columns[f.name].cast(f.type)
                            if isinstance(columns[f.name], pa.Array)
                            else pa.array(columns[f.name], f.type)
                            for f in arrow
                        ],
                        schema=arrow,
                    )
        give_back_memory()

    return df.mapInArrow(run, fields)
