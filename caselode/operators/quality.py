"""Data-quality checks on the corpus table (QA-1 .. QA-11)."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from caselode import profile as P
from caselode.functions.extract import preview
from caselode.functions.text import is_empty, words

_VALID = "valid_min_200_kata"


def _tier(n: Column) -> Column:
    return (
        F.when(n >= P.TARGET_VALID, "OK").when(n >= P.REQUIRED_VALID, "WARN").otherwise("FAIL")
    )


def counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_total"), F.count_if(_VALID).alias("n_valid")
    ).select(
        "n_total", "n_valid",
        (F.col("n_total") - F.col("n_valid")).alias("n_invalid"),
        _tier(F.col("n_valid")).alias("status"),
    )


def missing_from(df: DataFrame, inventories: dict[str, DataFrame]) -> DataFrame:
    """Valid ids that an inventory lacks, one row per (inventory, id) (QA-2)."""
    valid = df.filter(_VALID).select("case_id")
    parts = (
        valid.join(ids.select("case_id"), "case_id", "left_anti").select(
            F.lit(name).alias("inventory"), "case_id"
        )
        for name, ids in inventories.items()
    )
    return reduce(DataFrame.unionByName, parts)


def inventory_sizes(inventories: dict[str, DataFrame]) -> DataFrame:
    parts = (
        ids.agg(F.countDistinct("case_id").alias("n_ids")).select(F.lit(name).alias("inventory"), "n_ids")
        for name, ids in inventories.items()
    )
    return reduce(DataFrame.unionByName, parts)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Mean, exact median, extremes and sample deviation of one measure (QA-3, QA-5).

    The exact median keeps one counter per distinct value.  Word counts and
    scores with four digits have few distinct values whatever the row count.
    """
    c = F.col(column)
    return df.agg(
        F.avg(c).alias("mean"),
        F.percentile(c, F.lit(0.5)).alias("median"),
        F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max"),
        F.stddev_samp(c).alias("std"),
    )


def short_documents(df: DataFrame) -> DataFrame:
    """Ids of empty and of short documents with their kind (QA-4)."""
    n = F.col("jumlah_kata")
    return df.filter(n < P.MIN_WORDS).select(
        "case_id", "jumlah_kata", F.when(n == 0, "empty").otherwise("short").alias("kind")
    )


def incomplete_documents(df: DataFrame) -> DataFrame:
    c = F.col("keutuhan_teks")
    return df.filter((c > 0) & (c < P.MIN_COMPLETENESS)).select("case_id", "keutuhan_teks")


def duplicated_rows(df: DataFrame, key: str = "no_perkara") -> DataFrame:
    """Every row whose key occurs more than once, with the number of copies (QA-6).

    Counting combines before the shuffle, and the join back may split the rows of a hot key.
    Groups stay long rows, never one array.
    """
    keyed = df.filter(~is_empty(F.col(key))).select(key, "case_id")
    repeated = keyed.groupBy(key).agg(F.count("*").alias("n_copies")).filter(F.col("n_copies") > 1)
    return keyed.join(repeated, key)


def missing_rates(df: DataFrame, columns=P.CHECKED_COLUMNS) -> DataFrame:
    """Empty values per column in one pass over the table (QA-7)."""
    wide = df.agg(
        F.count("*").alias("n_total"),
        *(F.count_if(is_empty(F.col(c))).alias(c) for c in columns),
    )
    rate = F.when(F.col("n_total") > 0, F.col("n_empty") / F.col("n_total")).otherwise(0.0)
    return wide.unpivot("n_total", list(columns), "column_name", "n_empty").select(
        "column_name", "n_empty", "n_total",
        F.round(rate * 100, 4).alias("pct_empty"),
        F.when(rate < P.MAX_MISSING_RATE, "OK").otherwise("WARN").alias("status"),
    )


def _retired(column: str) -> Column:
    return F.coalesce(F.lower(F.col(column)).contains(P.RETIRED_KIND.lower()), F.lit(False))


def categories(df: DataFrame, column: str = "jenis_perkara") -> DataFrame:
    """Rows per category, and whether it is the retired one (QA-8)."""
    return df.groupBy(column).agg(F.count("*").alias("n_rows")).withColumn("retired", _retired(column))


def drawn(df: DataFrame, n: int = 5, seed: int = P.SEED) -> DataFrame:
    """n valid ids in seeded hash order."""
    order = F.md5(F.concat("case_id", F.lit(f":{seed}")))
    return df.filter(_VALID).select("case_id").orderBy(order, "case_id").limit(n)


def previews(ids: DataFrame, texts: DataFrame, text: str = "normalised") -> DataFrame:
    """The drawn ids with size and preview; no text, no preview (QA-9)."""
    return ids.join(texts.select("case_id", text), "case_id", "left").select(
        "case_id",
        F.when(F.col(text).isNotNull(), words(F.col(text))).alias("n_words"),
        preview(F.col(text), P.SAMPLE_CHARS).alias("preview"),
        F.col(text).isNull().alias("text_missing"),
    )


def issues(
    df: DataFrame, missing: DataFrame, duplicated: DataFrame,
    texts: str = "raw", token_lists: str = "tokens",
) -> DataFrame:
    """One row per kind of finding that occurs, with its count (QA-10)."""
    found = [
        df.agg(F.count_if(_VALID).alias("n")).select(
            F.when(F.col("n") < P.REQUIRED_VALID, "valid_below_required")
            .when(F.col("n") < P.TARGET_VALID, "valid_below_target")
            .alias("issue"),
            "n",
        ),
        missing.filter(F.col("inventory") == texts).agg(F.count("*").alias("n")).select(
            F.lit("valid_without_text").alias("issue"), "n"),
        missing.filter(F.col("inventory") == token_lists).agg(F.count("*").alias("n")).select(
            F.lit("valid_without_tokens").alias("issue"), "n"),
        duplicated.agg(F.count("*").alias("n")).select(F.lit("duplicated_key_rows").alias("issue"), "n"),
        df.agg(F.count_if(_retired("jenis_perkara")).alias("n")).select(
            F.lit("retired_category_rows").alias("issue"), "n"),
    ]
    shortfall, *rest = found
    rest = reduce(DataFrame.unionByName, rest).filter(F.col("n") > 0)
    return shortfall.filter(F.col("issue").isNotNull()).unionByName(rest)


def verdict(issue_rows: DataFrame) -> DataFrame:
    return issue_rows.agg(F.count("*").alias("n_issues")).select(
        "n_issues",
        F.when(F.col("n_issues") == 0, "READY").otherwise("NEEDS_ATTENTION").alias("verdict"),
    )


def flags(
    df: DataFrame, missing: DataFrame, duplicated: DataFrame,
    texts: str = "raw", token_lists: str = "tokens",
) -> DataFrame:
    """Flagged ids with their reasons in fixed order, joined by ";" (QA-11)."""
    own = df.select(
        "case_id",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("jumlah_kata") == 0, 2),
                    F.when(
                        (F.col("keutuhan_teks") > 0)
                        & (F.col("keutuhan_teks") < P.MIN_COMPLETENESS),
                        3,
                    ),
                )
            )
        ).alias("code"),
    )
    absent = missing.filter(F.col("inventory").isin(texts, token_lists)).select(
        "case_id", F.when(F.col("inventory") == texts, 0).otherwise(1).alias("code")
    )
    copies = duplicated.select("case_id", F.lit(4).alias("code"))
    reasons = F.array(*(F.lit(r) for r in P.FLAG_REASONS))
    return (
        own.unionByName(absent)
        .unionByName(copies)
        .groupBy("case_id")
        .agg(F.array_sort(F.collect_set("code")).alias("codes"))  # five codes at most
        .select(
            "case_id",
            F.array_join(
                F.transform("codes", lambda c: F.element_at(reasons, c + 1)), ";"
            ).alias("alasan_perlu_dicek"),
        )
    )


def report_lines(**tables: DataFrame) -> DataFrame:
    """(section, line, value) of a report (SNK-3): per table a heading, then its rows as ``column: value``.

    Rows of a table go by their text; nulls are ``-``.  The tables are the small results of the checks.
    """
    parts = []
    for section, (title, table) in enumerate(tables.items()):
        fields = [
            F.concat(F.lit(f"{c}: "), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("-"))) for c in table.columns
        ]
        own = F.lit(section).alias("section")
        head = table.sparkSession.range(1).select(own, F.lit(0).alias("line"), F.lit(f"== {title} ==").alias("value"))
        parts += [head, table.select(own, F.lit(1).alias("line"), F.concat_ws(", ", *fields).alias("value"))]
    return reduce(DataFrame.unionByName, parts)
