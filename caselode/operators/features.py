"""Feature text, labels and the train/test split (VEC-1 .. VEC-4)."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from caselode import profile as P
from caselode.functions.extract import merged_label
from caselode.functions.text import strip
from caselode.session import staged

FEATURE_COLUMNS = ("ringkasan_fakta", "argumen_hukum", "pasal", "amar_putusan")


def combined_text(columns=FEATURE_COLUMNS) -> Column:
    """The feature columns joined by blanks, lower case, stripped; null counts as empty."""
    return strip(F.lower(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in columns))))


def case_features(cases: DataFrame) -> DataFrame:
    return cases.select(
        "case_id", "no_perkara", "jumlah_kata", "ringkasan_fakta", "amar_putusan", "text_full",
        combined_text().alias("text_combined"),
        merged_label(F.col("decision_type")).alias("label"),
    )


def classes(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, code): one row per distinct label, numbered in alphabetical order from 0."""
    names = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("label")).distinct()
    place = F.row_number().over(Window.orderBy("label")) - 1  # one row per class
    return names.select("label", place.alias("code"))


def label_codes(df: DataFrame, label: str = "label") -> DataFrame:
    """Add ``label_encoded``: the label's place in alphabetical order (VEC-3); null for none."""
    codes = classes(df, label).select(F.col("label").alias("_label"), F.col("code").alias("label_encoded"))
    joined = df.join(codes, F.col(label) == F.col("_label"), "left")
    return joined.select(*df.columns, "label_encoded")


def class_sizes(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n_class"))


def class_quotas(sizes: DataFrame, label: str = "label", share: float = P.TEST_SHARE) -> DataFrame:
    """Test rows per class: floor of the proportional share, rest by largest remainder.

    ``sizes`` is the table of ``class_sizes``.  When a class has a single row
    there is one group for all rows (VEC-4).  All windows run over one row per class.
    """
    every = Window.partitionBy()
    by_rest = Window.orderBy(F.desc("rest"), label)
    exact = F.col("n_class") * F.col("n_test")
    return (
        sizes.withColumn("n", F.sum("n_class").over(every))
        .withColumn("stratified", F.min("n_class").over(every) >= 2)
        .withColumn("n_test", F.ceil(F.col("n") * F.lit(share)).cast("long"))
        .withColumn("base", F.floor(exact / F.col("n")).cast("long"))
        .withColumn("rest", exact - F.col("base") * F.col("n"))
        .withColumn("open", F.col("n_test") - F.sum("base").over(every))
        .withColumn("quota", F.col("base") + (F.row_number().over(by_rest) <= F.col("open")).cast("long"))
        .select(label, "n_class", "stratified", "n_test", "quota")
    )


def stratified_split(
    df: DataFrame, id_col: str = "case_id", label: str = "label",
    share: float = P.TEST_SHARE, seed: int = P.SEED,
) -> DataFrame:
    """(id, label, split): the quota's smallest seeded hashes of each class are test rows.

    Ranking a whole class in one window would put it into one task.  Instead
    a histogram over the first hash digits finds, per class, the bucket where
    the quota runs out; only the rows of that bucket are ranked, about one in
    65,536.  The histogram and the limits are written once: two small tables,
    bounded by classes times buckets.
    """
    hashed = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    keyed = df.select(
        id_col, label, hashed.alias("h"),
        F.conv(F.substring(hashed, 1, 4), 16, 10).cast("int").alias("bucket"),
    )
    histogram = staged(keyed.groupBy(label, "bucket").agg(F.count("*").alias("n")), "histogram")
    quotas = class_quotas(histogram.groupBy(label).agg(F.sum("n").alias("n_class")), label, share)
    group = F.when(F.col("stratified"), F.col(label)).otherwise(F.lit(""))
    groups = quotas.select(label, "quota", group.alias("grp"))
    running = Window.partitionBy("grp").orderBy("bucket")
    before = F.col("upto") - F.col("n")
    edges = (
        histogram.join(groups.select(label, "grp"), label)
        .groupBy("grp", "bucket")
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .join(groups.groupBy("grp").agg(F.sum("quota").alias("quota")), "grp")
        .filter(F.col("upto") >= F.col("quota"))
        .groupBy("grp")
        .agg(F.min(F.struct("bucket", (F.col("quota") - before).alias("left"))).alias("e"))
    )
    limits = staged(
        groups.join(edges, "grp").select(
            label, "grp", F.col("e.bucket").alias("edge"), F.col("e.left").alias("left")
        ),
        "limits",
    )
    placed = keyed.join(limits, label)
    split = F.when(F.col("test"), "test").otherwise("train").alias("split")
    clear = placed.filter(F.col("bucket") != F.col("edge")).withColumn(
        "test", F.col("bucket") < F.col("edge")
    )
    rank = F.row_number().over(Window.partitionBy("grp").orderBy("h", id_col))
    close = placed.filter(F.col("bucket") == F.col("edge")).withColumn(
        "test", rank <= F.col("left")
    )
    return clear.unionByName(close).select(id_col, label, split)
