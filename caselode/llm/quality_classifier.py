"""Quality classifier by co-training of two views.

One classifier sees the text's content: its shape, and what its words and word pairs say. One sees the page's
metadata (source, language, length). Both start from
the labelled documents; in every round each hands the documents of which it is confident, with the label
it gives them, to the other, unless that is as sure of the opposite. In the end each view is calibrated on labelled documents kept out of
training, and the calibrated views are combined to score all documents.

Classifiers are fitted on a bounded number of labelled documents and on whichever others the views hand over, by
Spark's own logistic regression; every document is scored and may be handed over in every round.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselode.session import staged

from . import words as w
from .common import map_batches
from .quality_rules import counts

ROUNDS = 2
#: Labelled documents that classifiers are fitted on, at most (about, by a hash of the id).
LABELLED_ROWS = 200_000
#: Share of the labelled documents that calibrate and are not trained on, in percent.
HELD_OUT = 25
CONFIDENT = 0.95
THRESHOLD = 0.5
META_FEATURES = 512
ITERATIONS = 25
#: Words are counted in so many buckets, and word pairs in as many.
BUCKETS = 1 << 16
#: A bucket starts as this many documents that say nothing; log-odds of fewer standard errors than NOISE count as 0.
BELIEF, NOISE = 2.0, 2.0

_TABLE, _FOLD = w.letter_words(), w.lower_case()


def text_features(data, borders) -> np.ndarray:
    """One row per text: shares that tell prose from junk, and their square roots."""
    c = counts(data, borders)
    words, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1)
    shares = [
        c["n_symbols"] / words, c["n_odd_words"] / words, c["n_repeat_words"] / words, c["n_dup_lines"] / lines,
        c["n_upper"] / np.maximum(c["n_letters"], 1), c["n_exclaim"] / words, c["n_same_as_last"] / words,
        c["n_control"] / np.maximum(c["word_chars"], 1),
    ]
    shares = [np.minimum(s, 2.0) for s in shares]
    sizes = [np.log1p(c["n_words"]) / 10, np.minimum(c["word_chars"] / words, 50) / 10, np.log1p(words / lines) / 5]
    return np.stack([*shares, *map(np.sqrt, shares), *sizes], 1).astype(np.float32)


def _buckets(data, borders, size):
    """(bucket, text) of every word, and of every pair of neighbouring words, in the `size` buckets behind."""
    words = w.Words(data, borders, _TABLE, _FOLD)
    hashes, text = words.hashes(), words.text_of_word()
    pairs, first = w.windows(hashes, words.first, 2)
    shift = np.uint64(65 - size.bit_length())
    return ((hashes >> shift).astype(np.int64), text), ((pairs >> shift).astype(np.int64) + size, text[first])


def _half(id_col: str) -> Column:
    """Which of two halves a document is in: what a half's words say is learnt from the other half."""
    return F.pmod(F.xxhash64(F.col(id_col), F.lit("half")), F.lit(2)).cast("int")


def log_odds(good, bad, n_good, n_bad) -> np.ndarray:
    """Log-odds that a document is good if it has a bucket, against those of all; 0 where that may be chance."""
    if not n_good or not n_bad:
        return np.zeros(len(good))
    share = n_good / (n_good + n_bad)
    g, b = good + BELIEF * share, bad + BELIEF * (1 - share)
    odds = np.log(g / b) - np.log(share / (1 - share))
    return np.where(np.abs(odds) >= NOISE * np.sqrt(1 / g + 1 / b), odds, 0.0)


def learn_words(docs: DataFrame, labels: DataFrame, id_col, text_col) -> np.ndarray | None:
    """For each half of the documents the log-odds of every bucket, from the labelled documents of the other half.

    `labels` (id, label) as for cotrain(). Counted are the documents that have a bucket, of those that train; tasks add
    up arrays of fixed size, of which only sums reach the driver. None without any labelled document.
    """
    ids = docs.select(F.col(f"`{id_col}`").alias("_own"))
    known = _known(labels).withColumnRenamed("_label_id", "_id")
    known = staged(known.join(ids, F.col("_id") == F.col("_own"), "left_semi").filter(~_held_out()), "labelled")
    n_known = known.count()
    if not n_known:
        return None
    few = _sampled(known, n_known, LABELLED_ROWS).select("_id", F.col("label").cast("int").alias("label"))
    rows = docs.select(F.col(f"`{id_col}`").alias("_own"), F.col(f"`{text_col}`").alias("_text"))
    rows = rows.join(F.broadcast(few), F.col("_own") == F.col("_id")).select(
        "_text", (2 * _half("_own") + F.col("label")).alias("_group")
    )
    size, width = BUCKETS, 2 * BUCKETS

    def count(batches):
        total = np.zeros((4, width + 1), np.int64)
        for batch in batches:
            group = np.asarray(batch.column("_group"))
            for a, b, data, borders in w.pieces(batch.column("_text")):
                for bucket, text in _buckets(data, borders, size):
                    pairs = np.unique(text * width + bucket)
                    np.add.at(total, (group[a:b][pairs // width], pairs % width), 1)
            total[:, width] += np.bincount(group, minlength=4)
        flat = total.ravel()
        place = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(flat[place])], names=["place", "n"])

    # at most four times the number of buckets, and four
    sums = rows.mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(4 * (width + 1))
    total[np.asarray(sums["place"])] = np.asarray(sums["n"])
    total = total.reshape(2, 2, width + 1)
    return np.stack([log_odds(t[1, :-1], t[0, :-1], t[1, -1], t[0, -1]) for t in total[::-1]])


def word_features(data, borders, odds, half) -> np.ndarray:
    """One row per text: the mean and the bounded sum of what its words say, and of what its word pairs say."""
    n, out = len(borders) - 1, []
    for bucket, text in _buckets(data, borders, odds.shape[1] // 2):
        said = np.bincount(text, odds[half[text], bucket], n)
        out += [said / np.maximum(np.bincount(text, minlength=n), 1), np.clip(said / 10, -2, 2)]
    return np.stack(out, 1).astype(np.float32)


def described(docs: DataFrame, columns: dict[str, str], id_col, text_col, meta_cols, odds=None) -> DataFrame:
    """Some columns of `docs` under given names, with `features` of the text, those of its words if `odds` (of
    learn_words(), broadcast) are given, and `meta` features."""
    used = [id_col, text_col, *meta_cols]
    # a column that is passed on anyway is not sent twice
    names = columns | {c: f"_c{i}" for i, c in enumerate(used) if c not in columns}
    own = [names[c] for c in used]
    chosen = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    keep = [f for f in chosen.schema.fields if f.name != own[1] or text_col in columns]
    if odds is not None:
        chosen = chosen.withColumn("_half", _half(own[0]))

    def measure(batch):
        for a, b, data, borders in w.pieces(batch.column(own[1])):
            x = text_features(data, borders)
            if odds is not None:
                half = np.asarray(batch.column("_half"))[a:b]
                x = np.concatenate([x, word_features(data, borders, odds.value, half)], 1)
            cut = pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32())
            rest = {f.name: batch.column(f.name)[a:b] for f in keep}
            yield rest | {"features": pa.ListArray.from_arrays(cut, pa.array(x.ravel()))}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + ", features array<float>"
    out = map_batches(chosen, measure, schema)
    return out.select(
        *columns.values(), "features", F.col(own[0]).alias("_id"), *[F.col(own[i]).alias(f"_{i}") for i in (2, 3, 4)]
    )


@dataclass
class CoTrained:
    """The two fitted views, their calibrations (slope, offset), and the share of good documents."""

    text: object
    meta: object
    hasher: object
    calibration: tuple
    prior: float

    def scored(self, rows: DataFrame) -> DataFrame:
        """`rows` of described() with text_score, meta_score and score."""
        if self.text is None:
            constant = F.lit(self.prior)
            return rows.withColumns({"text_score": constant, "meta_score": constant, "score": constant})
        out = _raw(rows, self.hasher, self.text, self.meta)
        text, meta = (a * F.col(c) + b for (a, b), c in zip(self.calibration, ("_text", "_meta")))
        # the views are taken as independent given the class, so their evidence adds up
        prior = float(np.log(self.prior / (1 - self.prior)))
        return out.withColumns(
            {
                "text_score": F.round(_share(text), 6),
                "meta_score": F.round(_share(meta), 6),
                "score": F.round(_share(text + meta - F.lit(prior)), 6),
            }
        ).drop("_text", "_meta")


def _share(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-F.least(F.greatest(log_odds, F.lit(-40.0)), F.lit(40.0))))


def _with_meta(rows, hasher):
    """`rows` with the vectors of both views; a null is a value of its own."""
    size = F.when(F.col("_4").isNull(), F.lit("none")).otherwise(
        F.floor(F.log2(F.greatest(F.col("_4").cast("double"), F.lit(1.0))) * 2).cast("string")
    )
    named = rows.withColumns(
        {"_s": F.coalesce(F.col("_2").cast("string"), F.lit("")), "_l": F.coalesce(F.col("_3").cast("string"), F.lit("")),
         "_n": size, "_x": array_to_vector("features")}
    )
    return hasher.transform(named)


def _raw(rows, hasher, text_model, meta_model, keep_vectors=False):
    """Log-odds of both views as `_text` and `_meta`."""
    vectors = _with_meta(rows, hasher)
    for name, model in (("_text", text_model), ("_meta", meta_model)):
        vectors = model.transform(vectors).withColumn(name, vector_to_array(F.col("_raw"))[1])
        vectors = vectors.drop("_raw", "_probability", "_prediction")
    return vectors if keep_vectors else vectors.drop("_s", "_l", "_n", "_x", "_m")


def _sampled(rows: DataFrame, n_rows: int, most: int) -> DataFrame:
    """About `most` of the rows, by a hash of the id; all of them if there are no more."""
    if n_rows <= most:
        return rows
    return rows.filter(F.pmod(F.xxhash64("_id", F.lit("pool")), F.lit(1_000_000)) < int(1e6 * most / n_rows))


def _known(labels: DataFrame) -> DataFrame:
    """(_label_id, label) of the ids whose labels agree."""
    known = labels.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    return known.filter("label = other").select(F.col("id").alias("_label_id"), F.col("label").cast("double").alias("label"))


def _held_out() -> Column:
    return F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(100)) < HELD_OUT


def cotrain(rows: DataFrame, labels: DataFrame, rounds=ROUNDS) -> CoTrained:
    """Fit on `rows` of described() and labels (id, label 0 or 1).

    An id with contradicting or null labels counts as unlabelled. Without labels of both classes in
    the training part there is nothing to tell apart: the model then scores every document with the
    share of good labels, or 1 without any labels.
    """
    known = _known(labels)
    joined = rows.select("_id", "_2", "_3", "_4", "features").join(known, F.col("_id") == F.col("_label_id"), "left")
    joined = joined.withColumn("held_out", _held_out()).drop("_label_id")
    n_known = joined.agg(F.count("label")).first()[0]
    base = staged(
        _sampled(joined.filter("label is not null"), n_known, LABELLED_ROWS).union(
            joined.filter("label is null")
        ),
        "co-training",
    )
    good, n_train = base.filter("label is not null and not held_out").agg(F.sum("label"), F.count("*")).first()
    if not n_train or good in (0, n_train):
        return CoTrained(None, None, None, None, 1.0 if not n_train else good / n_train)
    hasher = FeatureHasher(inputCols=["_s", "_l", "_n"], outputCol="_m", numFeatures=META_FEATURES)
    fit = lambda view, df: LogisticRegression(
        featuresCol=view, labelCol="y", rawPredictionCol="_raw", probabilityCol="_probability",
        predictionCol="_prediction", maxIter=ITERATIONS, regParam=1e-3, tol=1e-5, maxBlockSizeInMB=1.0,
    ).fit(df.select(view, "y"))
    vectors = _with_meta(base, hasher)
    labelled = vectors.filter("label is not null and not held_out").withColumn("y", F.col("label"))
    text, meta = fit("_x", labelled), fit("_m", labelled)
    odds = float(np.log(CONFIDENT / (1 - CONFIDENT)))
    for _ in range(rounds):
        both = _raw(base.filter("label is null"), hasher, text, meta, keep_vectors=True)
        # a document on which the other view is as sure of the opposite teaches neither
        agreed = both.filter(~((F.least("_text", "_meta") <= -odds) & (F.greatest("_text", "_meta") >= odds)))
        from_text, from_meta = (
            agreed.filter(F.abs(c) >= odds).withColumn("y", (F.col(c) > 0).cast("double")) for c in ("_text", "_meta")
        )
        text, meta = (
            fit("_x", labelled.select("_x", "y").union(from_meta.select("_x", "y"))),
            fit("_m", labelled.select("_m", "y").union(from_text.select("_m", "y"))),
        )
    held = staged(_raw(base.filter("label is not null and held_out"), hasher, text, meta).select("label", "_text", "_meta"), "held-out")
    n_held, good_held = held.agg(F.count("*"), F.sum("label")).first()
    calibration = ((1.0, 0.0), (1.0, 0.0))
    if n_held and 0 < good_held < n_held:
        calibration = tuple(_calibrated(held, c) for c in ("_text", "_meta"))
    return CoTrained(text, meta, hasher, calibration, good / n_train)


def _calibrated(held: DataFrame, column: str):
    """Slope and offset that turn a view's log-odds into calibrated ones (Platt)."""
    # sums over label and rounded log-odds: a bounded table, whatever the number of documents
    bins = held.groupBy("label", F.round(F.least(F.greatest(F.col(column), F.lit(-30.0)), F.lit(30.0)), 1).alias("x")).count()
    found = np.array([(r["label"], r["x"], r["count"]) for r in bins.orderBy("label", "x").collect()], float)
    y, x, n = found.T
    # one pseudo-document of each class at every end keeps separable data finite
    y, x, n = np.append(y, [0, 1]), np.append(x, [x.max(), x.min()]), np.append(n, [1, 1])
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-(a * x + b)))
        g = np.array([((y - p) * n * x).sum() - 1e-3 * a, ((y - p) * n).sum()])
        v = p * (1 - p) * n
        h = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step = step * min(1.0, 1.0 / max(np.abs(step).max(), 1e-12))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 0.0)), float(b)


def _labels(labels: DataFrame, label_id, label_col):
    return labels.select(F.col(f"`{label_id}`").alias("id"), F.col(f"`{label_col}`").alias("label")).dropna()


def _odds(docs, labels, id_col, text_col):
    odds = learn_words(docs, labels, id_col, text_col)
    return None if odds is None else docs.sparkSession.sparkContext.broadcast(odds)


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", source_col="source", lang_col="lang",
    chars_col="n_chars", label_id="doc_id", label_col="quality",
) -> DataFrame:
    """One row per row of `docs`: id, text_score, meta_score, score (that it is good), kept.

    Null texts count as empty, null metadata as a value of its own. Texts are read whole, however long. Rows that
    repeat are scored alike. A score of exactly the threshold keeps the document. An empty table gives no rows;
    other columns, whatever their names, are not read.
    """
    known = _labels(labels, label_id, label_col)
    meta = [source_col, lang_col, chars_col]
    rows = staged(described(docs, {}, id_col, text_col, meta, _odds(docs, known, id_col, text_col)), "quality-features")
    model = cotrain(rows, known)
    return model.scored(rows).select(
        F.col("_id").alias(id_col), "text_score", "meta_score", "score", (F.col("score") >= THRESHOLD).alias("kept")
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", source_col="source", lang_col="lang",
    chars_col="n_chars", label_id="doc_id", label_col="quality",
) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns."""
    known = _labels(labels, label_id, label_col)
    meta, odds = [source_col, lang_col, chars_col], _odds(docs, known, id_col, text_col)
    rows = staged(described(docs, {}, id_col, text_col, meta, odds), "quality-features")
    model = cotrain(rows, known)
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    # scored anew in the pass that filters, so that rows need no key
    kept = model.scored(described(docs, names, id_col, text_col, meta, odds)).filter(F.col("score") >= THRESHOLD)
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])
