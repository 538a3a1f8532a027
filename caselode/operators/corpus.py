"""Building the corpus: measured texts, link lists, deduplication, stopping rule."""

from pyspark.sql import DataFrame, Window, functions as F

from caselode import profile as P
from caselode.functions import html, text as T

# Parts of the order column's range in which the stopping row is sought.
BUCKETS = 65_536


def measured(df: DataFrame, raw: str = "raw_text") -> DataFrame:
    """Clean and measure one raw text per row; narrow, no shuffle.

    A raw text below the word limit counts as an image scan: its cleaned text
    is empty and ``status`` says so (TXT-10).
    """
    text, cleaned = F.col(raw), F.col("cleaned")
    long_enough = F.col("raw_words") >= P.MIN_RAW_WORDS
    kind = F.when(text == "", "no_text").when(~long_enough, "scan_skip").otherwise("text")
    df = df.withColumn(raw, F.coalesce(raw, F.lit("")))
    df = T.computed(df, raw_words=T.words(text))
    df = T.computed(df, cleaned=F.when(long_enough, T.clean(text)).otherwise(""))
    df = T.computed(df, jumlah_kata=T.words(cleaned), _content=T.content_words(text))
    score = T.completeness(F.col("jumlah_kata"), F.col("_content"))
    return df.select(
        *(c for c in df.columns if c != "_content"),
        F.bround(score, 4).alias("keutuhan_teks"),
        T.is_valid(F.col("jumlah_kata"), score).alias("valid_min_200_kata"),
        kind.alias("status"),
    )


def normalised(df: DataFrame, cleaned: str = "cleaned") -> DataFrame:
    """Add the normalised text and its number of tokens (TXT-4 .. TXT-6)."""
    df = T.computed(df, normalised=T.normalise(F.col(cleaned)))
    return df.withColumn("jumlah_token", F.size(T.tokens(F.col("normalised"))))


def longest_per_key(df: DataFrame, key: str, size: str, id_col: str) -> DataFrame:
    """One row per key, the longest, ties by id; rows without a key all stay (TXT-11).

    An aggregate, not a window: each task keeps one row per key before the
    shuffle, so a key that holds a third of all rows costs nothing extra.
    """
    # a row without a key is a group of its own
    keyless = T.is_empty(F.col(key))
    row = F.struct(*df.columns)
    return (
        df.groupBy(F.when(~keyless, F.col(key)).alias("_key"), F.when(keyless, F.col(id_col)).alias("_id"))
        .agg(F.min_by(row, F.struct(-F.col(size), F.col(id_col))).alias("_row"))
        .select("_row.*")
    )


def run_summary(df: DataFrame) -> DataFrame:
    """Rows, valid rows, and rows with a document link but no words (TXT-12)."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if("valid_min_200_kata").alias("n_valid"),
        F.count_if((F.col("jumlah_kata") == 0) & (F.col("url_pdf") != "")).alias("n_scan_skip"),
    )


def until_enough_valid(
    new: DataFrame, recorded: DataFrame, target: int = P.TARGET_VALID,
    order: str = "seq", id_col: str = "case_id",
) -> DataFrame:
    """Rows taken in order until ``target`` valid rows were seen (INC-3).

    Recorded ids are skipped; their valid rows count first.  A row is taken
    while fewer than ``target`` valid rows stand before it, that is up to the
    row that is the last one wanted.  A histogram over the order column finds
    the bucket where that row lies, and only this bucket is numbered.
    """
    valid = F.col("valid_min_200_kata")
    fresh = new.join(recorded.select(id_col), id_col, "left_anti")
    left = F.lit(target) - recorded.filter(valid).agg(F.count("*")).scalar()
    at = F.col(order).cast("long")
    coming = fresh.filter(valid).select(at.alias("at"))
    ends = coming.agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    low, high = ends.select("lo").scalar(), ends.select("hi").scalar()
    bucket = F.floor((F.col("at") - low).cast("double") * BUCKETS / (high - low + 1))
    counted = coming.select("at", bucket.alias("bucket"))
    histogram = counted.groupBy("bucket").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy("bucket"))  # BUCKETS rows at most
    edge = (
        histogram.select("bucket", (upto - F.col("n")).alias("before"), upto.alias("upto"))
        .filter(F.col("upto") >= left).agg(F.min(F.struct("bucket", "before")).alias("e"))
    )
    inside = counted.join(edge.select("e.*"), "bucket")
    place = F.col("before") + F.row_number().over(Window.partitionBy("bucket").orderBy("at"))
    last = inside.withColumn("place", place).filter(F.col("place") <= left).agg(F.max("at"))
    # nothing once recorded rows reach the target; no bound while it is missed
    bound = F.when(left <= 0, F.lit(-(2**63))).otherwise(F.coalesce(last.scalar(), F.lit(2**63 - 1)))
    return fresh.filter(at <= bound)


def listing_links(
    pages: DataFrame, pattern: str = P.DETAIL_LINK, limit: int = P.LINK_TARGET,
    page: str = "page_id", body: str = "html",
) -> DataFrame:
    """Unique links in first-seen order, up to the first page without any (WEB-1)."""
    found = pages.select(page, html.links(F.col(body), pattern).alias("targets"))
    first_bare = found.filter(F.size("targets") == 0).agg(F.min(page))
    seen = (
        found.filter(F.col(page) < F.coalesce(first_bare.scalar(), F.lit(2**63 - 1)))
        .select(page, F.posexplode("targets").alias("pos", "url"))
        .groupBy("url")
        .agg(F.min(F.struct(page, "pos")).alias("first"))
    )
    return (
        seen.orderBy("first")
        .limit(limit)
        .select("url", F.col(f"first.{page}").alias("first_page"), F.col("first.pos").alias("first_pos"))
    )


def page_records(
    pages: DataFrame, body: str = "html", url: str = "url", position: str = "page_id", keep=()
) -> DataFrame:
    """Metadata of the pages that carry a detail table (WEB-2 .. WEB-5); ``keep`` are columns to pass on."""
    # the walks run once per page: neither the filter nor a field repeats them
    table = T.computed(pages, _table=html.detail_table(F.col(body))).filter(F.col("_table") != "")
    table = T.computed(table, _cells=html.read_cells(html.without_first(F.col("_table"), "h2")))
    return table.select(
        html.case_id(F.col(url), F.col(position)).alias("case_id"),
        html.heading(F.col("_table"), "h2").alias("judul"),
        F.lit(P.CASE_KIND).alias("jenis_perkara"),
        F.lit(P.COURT).alias("pengadilan"),
        F.col(url).alias("url_detail"),
        html.first_link(F.col(body)).alias("url_pdf"),
        *html.fields(F.col("_cells")),
        *keep,
    )


MEASURES = ("jumlah_kata", "jumlah_token", "keutuhan_teks", "valid_min_200_kata")


def full_records(records: DataFrame, measures: DataFrame, on: str, columns) -> DataFrame:
    """Page records with the measures of their texts, all ``columns`` in order (WEB-6).

    A page without a text has no words and is not valid.
    """
    joined = records.join(measures.select(on, *MEASURES), on, "left")
    return joined.fillna(0, MEASURES[:3]).fillna(False, MEASURES[3:]).select(*columns)
