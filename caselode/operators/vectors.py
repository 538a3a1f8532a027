"""TF-IDF as tables: vocabulary, document vectors, weights (VEC-5 .. VEC-8).

Documents are hash-partitioned by id before their terms are exploded, so counting
by (id, term) is local.  ``fitted`` never counts terms per document that are in no vector: it finds
the vocabulary by term alone, and counts the chosen terms of every document in a second scan of the texts.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from caselode import profile as P
from caselode.functions.text import computed
from caselode.session import staged


def _tasks(df: DataFrame) -> int:
    """A fixed number: merging small text partitions would undo the parallel term work."""
    spark = df.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(wanted, spark.sparkContext.defaultParallelism)


def _exploded(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, term): words of two or more characters and pairs of neighbours."""
    words = F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(P.TERM_TOKEN), F.lit(0)
    )

    rows = docs.select(id_col, text).repartition(_tasks(docs), id_col)
    # behind a generator the words are found once; pairs are made in generated code, not in a lambda
    rows = rows.select(id_col, F.explode(F.array(words)).alias("w"))
    n = F.greatest(F.size("w") - 1, F.lit(0))
    rows = rows.select(id_col, F.inline_outer(F.arrays_zip(F.col("w").alias("a"), F.slice("w", F.lit(2), n).alias("b"))))
    both = F.array("a", F.concat("a", F.lit(" "), "b"))
    return rows.select(id_col, F.explode(F.when(F.col("b").isNull(), F.array("a")).otherwise(both)).alias("term"))


def term_counts(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, term, tf) of every document; one row with a null term for a document without any.

    ``vocabulary`` and ``vectors`` start from this table.
    """
    return _exploded(docs, id_col, text).groupBy(id_col, "term").agg(F.count("*").alias("tf"))


def vocabulary(
    counts: DataFrame, n_docs: int, min_df: int = P.MIN_DF, max_features: int = P.MAX_FEATURES
) -> DataFrame:
    """(term, idx, df, cf, idf): the most frequent terms of ``term_counts``, ties alphabetical."""
    terms = counts.filter(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
    chosen = _most_frequent(terms.filter(F.col("df") >= min_df), max_features)
    return chosen.select("term", "idx", "df", "cf", _idf(n_docs))


def _most_frequent(terms: DataFrame, max_features: int) -> DataFrame:
    """The most frequent of ``terms``, ties alphabetical, with ``idx``, their place in the alphabet."""
    kept = terms.orderBy(F.desc("cf"), "term").limit(max_features)
    return kept.withColumn("idx", F.row_number().over(Window.orderBy("term")) - 1)  # max_features rows


def _idf(n_docs: int) -> Column:
    return (F.log((1 + F.lit(n_docs)) / (1 + F.col("df"))) + 1).alias("idf")


def fitted(
    docs: DataFrame, id_col: str, text: str, n_docs: int,
    min_df: int = P.MIN_DF, max_features: int = P.MAX_FEATURES,
) -> tuple[DataFrame, DataFrame]:
    """``vocabulary`` and ``vectors`` of the same documents, without the counts of all their terms.

    Terms are added up over all documents; whether a term has a second document shows in the least and
    the largest hash of its ids.  Only the chosen terms are then counted in every document, which gives their ``df``.
    """
    if min_df > 2:
        counts = staged(term_counts(docs, id_col, text), "counts")
        vocab = staged(vocabulary(counts, n_docs, min_df, max_features), "vocabulary")
        return vocab, vectors(counts, vocab, id_col)
    own = F.xxhash64(id_col)
    terms = _exploded(docs, id_col, text).filter(F.col("term").isNotNull()).groupBy("term").agg(
        F.count("*").alias("cf"), F.min(own).alias("least"), F.max(own).alias("largest")
    )
    if min_df == 2:
        terms = terms.filter(F.col("least") != F.col("largest"))
    chosen = staged(_most_frequent(terms, max_features).select("term", "idx", "cf"), "terms")
    known = staged(known_terms(docs, chosen, id_col, text), "known")
    df = known.select(F.explode("known.idx").alias("idx")).groupBy("idx").agg(F.count("*").alias("df"))
    vocab = staged(chosen.join(df, "idx").select("term", "idx", "df", "cf", _idf(n_docs)), "vocabulary")
    return vocab, weighted(known, vocab, id_col)


def known_terms(docs: DataFrame, vocab: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, known): the terms of every document that ``vocab`` has, as (idx, tf) in order of idx.

    The terms meet the vocabulary, max_features rows, before they are counted; nothing but the texts is shuffled.
    """
    places = F.broadcast(vocab.select("term", "idx"))
    counts = _exploded(docs, id_col, text).join(places, "term", "left").groupBy(id_col, "idx").agg(F.count("*").alias("tf"))
    entry = F.when(F.col("idx").isNotNull(), F.struct("idx", "tf"))
    return counts.groupBy(id_col).agg(F.array_sort(F.collect_list(entry)).alias("known"))


def weighted(known: DataFrame, vocab: DataFrame, id_col: str) -> DataFrame:
    """``vectors`` from the table of ``known_terms``."""
    in_order = F.array_sort(F.collect_list(F.struct("idx", "idf")))
    idf = vocab.agg(F.transform(in_order, lambda x: x["idf"])).scalar()  # max_features numbers
    w = F.transform("known", lambda x: (1 + F.log(x["tf"])) * F.get("idf", x["idx"]))
    length = F.sqrt(F.aggregate("w", F.lit(0.0), lambda total, x: total + x * x))
    rows = computed(known.withColumn("idf", idf), w=w).drop("idf")
    return computed(rows, len=length).select(
        id_col, F.col("known.idx").alias("indices"), F.transform("w", lambda x: x / F.col("len")).alias("values")
    )


def transformed(docs: DataFrame, vocab: DataFrame, id_col: str, text: str) -> DataFrame:
    """The vectors of ``docs`` under a fitted vocabulary."""
    return weighted(known_terms(docs, vocab, id_col, text), vocab, id_col)


def vectors(counts: DataFrame, vocab: DataFrame, id_col: str) -> DataFrame:
    """(id, indices, values): unit-length vectors in term order, empty for no known term.

    Unknown terms leave no entry, but every document keeps a row.
    """
    known = counts.join(vocab.select("term", "idx", "idf"), "term", "left")
    w = (1 + F.log("tf")) * F.col("idf")
    entry = F.when(F.col("idx").isNotNull(), F.struct("idx", w.alias("w")))
    gathered = known.groupBy(id_col).agg(
        F.array_sort(F.collect_list(entry)).alias("e"), F.sqrt(F.sum(w**2)).alias("len")
    )
    return gathered.select(
        id_col,
        F.transform("e", lambda x: x["idx"]).alias("indices"),
        F.transform("e", lambda x: x["w"] / F.col("len")).alias("values"),
    )


def weights(vecs: DataFrame, id_col: str) -> DataFrame:
    """(id, idx, weight): the long form of the vectors."""
    pairs = F.arrays_zip(F.col("indices").alias("idx"), F.col("values").alias("weight"))
    return vecs.select(id_col, F.inline(pairs))
