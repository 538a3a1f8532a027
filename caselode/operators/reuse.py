"""Reusing the neighbours' outcome (USE-1 .. USE-4)."""

from pyspark.sql import Column, DataFrame, functions as F

from caselode import profile as P
from caselode.functions.text import blank_to_empty


def solution_text(*columns: str) -> Column:
    """The first column that is not blank, stripped; else empty (USE-1)."""
    return F.coalesce(*(F.nullif(blank_to_empty(F.col(c)), F.lit("")) for c in columns), F.lit(""))


def _chosen(neighbours: DataFrame, strategy: str) -> DataFrame:
    votes = (
        neighbours.withColumn("solution", blank_to_empty(F.col("solution")))
        .filter(F.col("solution") != "")
        .groupBy("query_id", "solution")
        .agg(
            F.count("*").alias("n"),
            F.round(F.sum("sim"), 9).alias("total"),
            F.max("sim").alias("best"),
            (-F.min("rank")).alias("early"),
        )
    )
    order = {
        "majority": F.struct("n", "total", "early"),
        "weighted": F.struct("total", "best", "early"),
    }[strategy]
    return votes.groupBy("query_id").agg(F.max_by("solution", order).alias("predicted_solution"))


def choose_solution(queries: DataFrame, neighbours: DataFrame, strategy: str = "weighted") -> DataFrame:
    """One solution per query by majority or similarity-weighted vote (USE-2, USE-3).

    Blank solutions do not vote; a query without any vote gets an empty one.
    """
    return queries.select("query_id").join(_chosen(neighbours, strategy), "query_id", "left").select(
        "query_id", F.coalesce("predicted_solution", F.lit("")).alias("predicted_solution")
    )


def predictions(
    queries: DataFrame, neighbours: DataFrame, strategy: str = "weighted"
) -> DataFrame:
    """(query_id, predicted_solution, top_5_case_ids) for all queries in one job (USE-4)."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", F.col("doc_id").cast("string").alias("id"))))
    ids = neighbours.groupBy("query_id").agg(
        F.array_join(F.transform(ranked, lambda x: x["id"]), "|").alias("top_5_case_ids")
    )
    return (
        choose_solution(queries, neighbours, strategy)
        .join(ids, "query_id", "left")
        .fillna("", ["top_5_case_ids"])
    )
