"""Scans (SRC-1 .. SRC-4) and fitted tables (SNK-4)."""

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from caselode.sources import schemas

FITTED = ("vocabulary", "split", "classes", "nb_terms", "nb_priors")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash the rows over all cores when the scan has fewer files than cores and is small.

    A file of one row group is one task; text work on a few of them would leave cores idle.  An input
    with files enough, or with a full split for every core, passes through without a shuffle.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores, key) if len(df.inputFiles()) < cores and size < cores * split else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def corpus(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """(case_id, text) from one file per case, the id taken from the file name (SRC-1).

    Spark's scans pass over empty files, so the contents are joined to the listing: an empty file is a
    row with an empty text.  The listing holds names only; Spark lists a folder on the driver anyway.
    """
    files = spark.read.option("pathGlobFilter", f"*{suffix}").text(folder, wholetext=True)
    plain = lambda path: F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    name = F.regexp_extract(plain(F.col("_metadata.file_name")), rf"^(.*)\{suffix}$", 1)
    contents = files.select(name.alias("case_id"), F.col("value").alias("text"))
    paths = pa.table({"path": pa.array(files.inputFiles(), pa.string())})
    case_id = F.regexp_extract(plain(F.col("path")), rf"([^/]*)\{suffix}$", 1)
    listed = spark.createDataFrame(paths).select(case_id.alias("case_id"))
    empty = listed.join(contents.select("case_id"), "case_id", "left_anti")
    return contents.unionByName(empty.withColumn("text", F.lit("")))


def inventory(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """Ids that have a file with content; names only, the contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    return files.select(F.regexp_extract("path", rf"([^/]*)\{suffix}$", 1).alias("case_id"))


def token_lists(spark: SparkSession, folder: str) -> DataFrame:
    """(case_id, tokens) from one JSON array per file."""
    return corpus(spark, folder, ".json").select(
        "case_id", F.from_json("text", "array<string>").alias("tokens")
    )


def token_table(spark: SparkSession, path: str) -> DataFrame:
    """(case_id, tokens) from lines of records, as ``writers.token_lists`` leaves them."""
    return spark.read.schema(schemas.TOKENS).json(path)


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table under a fixed schema; quoted line ends and quotes are kept (SRC-2)."""
    return (
        spark.read.schema(schema)
        .option("header", True).option("multiLine", True).option("escape", '"')
        .csv(path)
    )


def query_set(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Nested query records from JSON arrays, or from lines of one record each (SRC-3)."""
    return spark.read.schema(schemas.QUERIES).option("multiLine", not lines).json(path)


def embeddings(
    spark: SparkSession, path: str, cases: DataFrame, id_col: str = "case_id"
) -> DataFrame:
    """Vectors of the cases, by id; no rows unless every case has one (SRC-4)."""
    stored = spark.read.parquet(path).select(id_col, "embedding")
    aligned = cases.select(id_col).join(stored, id_col)
    complete = (
        cases.join(stored, id_col, "left_anti").agg(F.count("*") == 0)
    )
    return aligned.filter(complete.scalar())


def report(spark: SparkSession, path: str) -> DataFrame:
    """(line, value): the lines of a stored report, numbered from 1 in their order."""
    whole = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("line", "value"))
    lines = whole.select((F.col("line") + 1).alias("line"), "value")
    return lines.filter("value != ''")


def bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def fitted(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a fitted model; a missing one is an error (SNK-4)."""
    tables = {}
    for name in FITTED:
        try:
            tables[name] = spark.read.parquet(f"{folder}/{name}")
        except AnalysisException as e:
            raise FileNotFoundError(f"{folder}/{name}: fit the model first") from e
    return tables


def svm(spark: SparkSession, folder: str) -> DataFrame:
    """The stored weights of an SVM, (label, code, idx, weight)."""
    try:
        return spark.read.parquet(f"{folder}/svm")
    except AnalysisException as e:
        raise FileNotFoundError(f"{folder}/svm: fit the model first") from e
