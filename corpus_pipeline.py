"""The corpus pipeline: stages from raw documents to encoded token ids.

Every stage works on all documents that the stage before kept, and its decisions take effect. The
stages share no state: each reads what it needs from its documents and from the tables of the folder.
Every stage takes null ids, texts and metadata, empty and very long texts, rows that repeat, empty tables, and
further columns of any name, which it passes on; an empty table of documents gives no rows in the end. Files between
the stages are deleted when the process ends, so its result must be written before.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselode.llm import decontaminate, jaccard_join, mixing, quality_classifier, token_output
from caselode.llm.queries import tokenizer_file
from caselode.session import own_folder


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject; without labels of both classes all stay."""
    return quality_classifier.keep_good(docs, _table(spark, sf_dir, "labels"))


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 85 % and more hold together: the one with the smallest id.

    Documents without words and groups without any id stay whole."""
    return jaccard_join.keep_one(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in 20 lies in a window of the benchmark; those without words stay."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in the target shares; documents that are taken twice are two rows, those without words none."""
    return mixing.mix(docs).withColumn("n_chars", F.length("text").cast("long"))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token segments; one row per document, as read back from them."""
    path = own_folder(spark, "tokens")
    token_output.write_tokens(docs, path, tokenizer_file())
    return token_output.token_digests(spark, path)


STAGES = [
    ("quality classifier", classify_quality),
    ("n-gram Jaccard join", join_near_duplicates),
    ("benchmark decontamination", remove_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]

#: Training and the token coder cannot be written as SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of a folder; each stage is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = own_folder(spark, f"stage-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
