"""Every registered query: (spark, folder) -> DataFrame over whole tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from caselode import profile as P
from caselode.functions import extract as X, html, text as T
from caselode.operators import (
    classify, corpus, evaluate, features, inverted, knn, linear, quality, represent, reuse, vectors,
)
from caselode.plans import views
from caselode.session import own_folder, staged
from caselode.sources import readers, schemas, writers
from caselode.sources.readers import spread, table
from caselode.streaming.incremental import forget_last_commit, run_available, unrecorded

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- texts ------------------------------------------------------------------------


@query
def text_clean(spark: SparkSession, folder: str) -> DataFrame:
    return views.case_texts(spark, folder).select(
        "doc_id", T.clean(F.col("raw_text")).alias("cleaned")
    )


@query
def text_normalize(spark, folder):
    cleaned = views.case_texts(spark, folder).select(
        "doc_id", T.clean(F.col("raw_text")).alias("cleaned")
    )
    return cleaned.select("doc_id", T.normalise(F.col("cleaned")).alias("normalised"))


@query
def text_tokens(spark, folder):
    return views.documents(spark, folder).select(
        "doc_id", F.array_join(T.tokens(F.col("text")), " ").alias("tokens")
    )


@query
def text_counts(spark, folder):
    return views.documents(spark, folder).select(
        "doc_id",
        T.words(F.col("text")).alias("n_words"),
        F.size(T.tokens(F.col("text"))).alias("n_tokens"),
    )


@query
def text_completeness(spark, folder):
    raw = F.col("raw_text")
    rows = T.computed(
        views.case_texts(spark, folder),
        content_words=T.content_words(raw), kept=T.words(T.clean(raw)),
    )
    score = T.completeness(F.col("kept"), F.col("content_words"))
    return rows.select("doc_id", "content_words", F.bround(score, 4).alias("keutuhan_teks"))


@query
def text_valid(spark, folder):
    return corpus.normalised(views.measured(spark, folder)).select(
        "case_id", "jumlah_kata", "jumlah_token", "keutuhan_teks", "valid_min_200_kata"
    )


@query
def text_scan_skip(spark, folder):
    return views.metadata(spark, folder).select("case_id", "raw_words", "status", "jumlah_kata")


@query
def take_until_valid(spark, folder):
    meta = views.staged_metadata(spark, folder).withColumn("seq", F.col("doc_id"))
    labelled = table(spark, folder, "labels").select(
        F.concat(F.lit("case_"), F.md5(F.col("doc_id").cast("string"))).alias("case_id")
    )
    recorded = meta.join(labelled, "case_id", "left_semi")
    n_recorded = table(spark, folder, "labels").count()
    taken = corpus.until_enough_valid(meta, recorded, target=n_recorded + P.TARGET_VALID)
    return taken.select("case_id", "seq", "valid_min_200_kata")


@query
def dedup_keep_longest(spark, folder):
    meta = views.metadata(spark, folder)
    kept = corpus.longest_per_key(meta, "no_perkara", "jumlah_kata", "case_id")
    return kept.select("case_id", "no_perkara", "jumlah_kata")


@query
def corpus_summary(spark, folder):
    return corpus.run_summary(views.metadata(spark, folder))


# --- pages ---------------------------------------------------------------------------


@query
def page_links(spark, folder):
    pages = spread(table(spark, folder, "pages"), "page_id")
    return corpus.listing_links(pages, pattern="^/")


@query
def page_heading(spark, folder):
    pages = spread(table(spark, folder, "pages"), "page_id")
    return pages.select(
        "page_id",
        html.heading(html.visible(F.col("html")), "h1").alias("heading"),
        html.heading(html.visible(F.col("html")), "title").alias("title"),
    )


@query
def page_ids(spark, folder):
    return views.detail_pages(spark, folder).select(
        "page_id", html.case_id(F.col("url"), F.col("page_id")).alias("case_id")
    )


@query
def page_fields(spark, folder):
    return corpus.page_records(views.detail_pages(spark, folder)).select(
        "case_id", "judul", *(name for name, _ in P.PAGE_FIELDS)
    )


@query
def page_record(spark, folder):
    """The text of page n is document n."""
    records = corpus.page_records(views.detail_pages(spark, folder), keep=("page_id",))
    texts = corpus.normalised(views.measured(spark, folder)).withColumn("page_id", F.col("doc_id"))
    columns = [c.strip().split(" ")[0] for c in schemas.METADATA.split(",")]
    return corpus.full_records(records, texts, "page_id", columns)


# --- quality ---------------------------------------------------------------------------


@query
def qa_counts(spark, folder):
    return quality.counts(views.metadata(spark, folder))


@query
def qa_inventory_missing(spark, folder):
    meta = views.staged_metadata(spark, folder)
    return quality.missing_from(meta, views.inventories(spark, folder))


@query
def qa_inventory_sizes(spark, folder):
    return quality.inventory_sizes(views.inventories(spark, folder))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) for c in df.columns))


@query
def qa_lengths(spark, folder):
    return _rounded(quality.distribution(views.metadata(spark, folder), "jumlah_kata"))


@query
def qa_short(spark, folder):
    return quality.short_documents(views.metadata(spark, folder))


@query
def qa_completeness(spark, folder):
    return _rounded(quality.distribution(views.metadata(spark, folder), "keutuhan_teks"))


@query
def qa_incomplete(spark, folder):
    return quality.incomplete_documents(views.metadata(spark, folder))


@query
def qa_duplicates(spark, folder):
    # the key and the id need no text measures: the raw text is never read
    return quality.duplicated_rows(views.case_texts(spark, folder))


@query
def qa_missing_rate(spark, folder):
    return quality.missing_rates(views.case_texts(spark, folder))


@query
def qa_categories(spark, folder):
    return quality.categories(views.case_texts(spark, folder))


@query
def qa_sample(spark, folder):
    drawn = staged(quality.drawn(views.metadata(spark, folder)), "drawn")
    have = drawn.join(views.inventories(spark, folder)["raw"].distinct(), "case_id")
    few = views.measured(spark, folder).join(have, "case_id")
    return quality.previews(drawn, corpus.normalised(few))


def _missing_and_copies(spark, folder):
    meta = views.staged_metadata(spark, folder)
    missing = quality.missing_from(meta, views.inventories(spark, folder))
    return meta, missing, quality.duplicated_rows(meta)


@query
def qa_issues(spark, folder):
    return quality.issues(*_missing_and_copies(spark, folder))


@query
def qa_verdict(spark, folder):
    return quality.verdict(quality.issues(*_missing_and_copies(spark, folder)))


@query
def qa_flags(spark, folder):
    return quality.flags(*_missing_and_copies(spark, folder))


# --- case records -------------------------------------------------------------------------


def _normalised(spark, folder):
    return views.valid_texts(spark, folder).select("case_id", "amar", "normalised")


@query
def rep_cases(spark, folder):
    return views.cases(spark, folder)


@query
def rep_cases_stored(spark, folder):
    """Case records from metadata and texts that are stored apart, both in buckets by case (REP-1)."""
    path, name = _new_folder(spark), f"t{uuid.uuid4().hex}"
    rows = staged(corpus.normalised(views.measured(spark, folder)).drop("raw_text", "cleaned"), "cases")
    writers.bucketed(rows.drop("normalised"), f"{name}_meta", f"{path}/meta")
    writers.bucketed(rows.select("case_id", "normalised"), f"{name}_texts", f"{path}/texts")
    stored = (readers.bucketed(spark, f"{name}_{part}") for part in ("meta", "texts"))
    return represent.case_records(represent.valid_with_text(*stored))


@query
def rep_parties(spark, folder):
    t = F.col("normalised")
    rows = _normalised(spark, folder).select(
        "case_id",
        X.parties(t, P.PLAINTIFF, P.PLAINTIFF_ALIAS).alias("p"),
        X.parties(t, P.DEFENDANT, P.DEFENDANT_ALIAS).alias("d"),
    )
    return rows.select(
        "case_id",
        F.col("p.names").alias("penggugat"), F.col("d.names").alias("tergugat"),
        F.col("p.n").alias("num_penggugat"), F.col("d.n").alias("num_tergugat"),
    )


@query
def rep_statutes(spark, folder):
    rows = _normalised(spark, folder).select("case_id", X.statutes(F.col("normalised")).alias("pasal"))
    return rows.select("case_id", "pasal", X.listed(F.col("pasal")).alias("jumlah_pasal_dirujuk"))


@query
def rep_facts(spark, folder):
    return _normalised(spark, folder).select(
        "case_id", X.facts(F.col("normalised")).alias("ringkasan_fakta")
    )


@query
def rep_arguments(spark, folder):
    return _normalised(spark, folder).select(
        "case_id", X.arguments(F.col("normalised")).alias("argumen_hukum")
    )


@query
def rep_decision(spark, folder):
    return _normalised(spark, folder).select(
        "case_id", X.decision(F.col("amar"), F.col("normalised")).alias("decision_type")
    )


@query
def rep_labels(spark, folder):
    return represent.label_distribution(views.cases(spark, folder))


@query
def rep_coverage(spark, folder):
    return represent.coverage(views.cases(spark, folder))


# --- features ---------------------------------------------------------------------------------


@query
def feature_text(spark, folder):
    return features.case_features(views.cases(spark, folder)).select("case_id", "text_combined", "label")


@query
def label_encode(spark, folder):
    rows = views.labelled_documents(spark, folder).select("case_id", "label")
    return features.label_codes(rows)


@query
def split_stratified(spark, folder):
    rows = views.labelled_documents(spark, folder).select("case_id", "label")
    return features.stratified_split(rows)


@query
def split_quotas(spark, folder):
    return features.class_quotas(features.class_sizes(views.labelled_documents(spark, folder)))


def _document_vectors(spark, folder):
    """Vocabulary and vectors of the documents."""
    docs = table(spark, folder, "documents")
    return vectors.fitted(docs, "doc_id", "text", docs.count())


def _document_vocabulary(spark, folder):
    return _document_vectors(spark, folder)[0]


def _asked_vectors(spark, folder, vocab):
    """Vectors of the benchmark queries; a blank query has none and finds nothing."""
    asked = views.benchmark(spark, folder).filter("query_text != ''")
    return vectors.transformed(asked, vocab, "query_id", "query_text")


@query
def tfidf_vocab(spark, folder):
    return _document_vocabulary(spark, folder).select(
        "term", "idx", "df", "cf", F.round("idf", 6).alias("idf")
    )


def _long(vecs, id_col):
    return vectors.weights(vecs, id_col).select(id_col, "idx", F.round("weight", 6).alias("weight"))


@query
def tfidf_weights(spark, folder):
    return _long(_document_vectors(spark, folder)[1], "doc_id")


@query
def tfidf_transform(spark, folder):
    return _long(_asked_vectors(spark, folder, _document_vocabulary(spark, folder)), "query_id")


# --- retrieval -----------------------------------------------------------------------------------


def _near(df, *columns):
    return df.select("query_id", "doc_id", F.round("sim", 6).alias("sim"), "rank", *columns)


def _sparse_documents(spark, folder):
    """Vectors of the documents and of the benchmark queries under one vocabulary."""
    vocab, vecs = _document_vectors(spark, folder)
    return _asked_vectors(spark, folder, vocab), vecs


def _sizes(spark, folder):
    return {
        "n_queries": table(spark, folder, "benchmark").count(),
        "n_docs": table(spark, folder, "documents").count(),
    }


@query
def retrieve_sparse(spark, folder):
    return _near(knn.top_k(*_sparse_documents(spark, folder), **_sizes(spark, folder)))


@query
def retrieve_inverted(spark, folder):
    """The same neighbours by inverted lists with bounds, without a Python worker."""
    return _near(inverted.top_k(*_sparse_documents(spark, folder)))


def _vectors(spark, folder):
    rows = table(spark, folder, "embeddings")
    return rows.select("vec_id", "embedding", F.col("label").cast("string").alias("label"))


@query
def retrieve_dense(spark, folder):
    return _near(knn.top_k(*_dense_test(spark, folder), dense=True, exclude_self=True))


def _dense_test(spark, folder):
    """The vectors of the test split as queries, and all vectors as documents."""
    rows = _vectors(spark, folder)
    split = features.stratified_split(rows, "vec_id").filter("split = 'test'")
    asked = staged(rows.join(split.select("vec_id"), "vec_id"), "asked")
    return asked.withColumnRenamed("vec_id", "query_id"), rows.withColumnRenamed("vec_id", "doc_id")


def _case_model(spark, folder):
    """Features, split, vocabulary and vectors of the cases; each written once."""
    rows = views.case_features(spark, folder)
    split = staged(features.stratified_split(rows), "split")
    vocab, vecs = vectors.fitted(rows, "case_id", "text_combined", rows.count())
    vecs = staged(vecs.join(split, "case_id"), "vectors")
    return rows, split, vocab, vecs


def _as_queries(vecs):
    return vecs.filter("split = 'test'").withColumnRenamed("case_id", "query_id")


def _as_docs(vecs):
    return vecs.withColumnRenamed("case_id", "doc_id")


def _test_neighbours(vecs):
    return knn.top_k(_as_queries(vecs), _as_docs(vecs), exclude_self=True)


@query
def self_similarity_topk(spark, folder):
    return _near(_test_neighbours(_case_model(spark, folder)[3]))


@query
def self_similarity_inverted(spark, folder):
    vecs = _case_model(spark, folder)[3]
    return _near(inverted.top_k(_as_queries(vecs), _as_docs(vecs), exclude_self=True))


def _train_neighbours(spark, folder):
    """Neighbours of the benchmark queries among the train documents, with solutions."""
    labelled = staged(views.solved_documents(spark, folder), "labelled")
    split = features.stratified_split(labelled)
    train = split.filter("split = 'train'").select("case_id")
    known = labelled.join(train, "case_id").select(
        "doc_id", reuse.solution_text("amar", "ringkasan_fakta", "label").alias("solution")
    )
    known = staged(known, "solutions")
    asked, docs = _sparse_documents(spark, folder)
    near = knn.top_k(asked, docs.join(known.select("doc_id"), "doc_id"), **_sizes(spark, folder))
    return views.benchmark(spark, folder), knn.with_solutions(near, known)


@query
def retrieve_train(spark, folder):
    return _near(_train_neighbours(spark, folder)[1], "solution")


@query
def representation_choice(spark, folder):
    return knn.representation(table(spark, folder, "documents"), table(spark, folder, "embeddings"))


@query
def retrieve_chosen_dense(spark, folder):
    """Every case has its vector, so the dense plan is chosen."""
    rows = table(spark, folder, "embeddings")
    near = knn.retrieve(
        rows.select("vec_id"), rows, lambda: knn.top_k(*_sparse_documents(spark, folder), **_sizes(spark, folder)),
        lambda: knn.top_k(*_dense_test(spark, folder), dense=True, exclude_self=True), "vec_id", "vec_id",
    )
    return _near(near, "method")


@query
def retrieve_chosen_sparse(spark, folder):
    """Not every document has its vector, so the sparse plan is chosen."""
    near = knn.retrieve(
        table(spark, folder, "documents"), table(spark, folder, "embeddings"),
        lambda: knn.top_k(*_sparse_documents(spark, folder), **_sizes(spark, folder)),
        lambda: knn.top_k(*_dense_test(spark, folder), dense=True, exclude_self=True), "doc_id", "vec_id",
    )
    return _near(near, "method")


@query
def retrieve_approximate_recall(spark, folder):
    """The neighbours of the test split by random projections, measured against the exact ones."""
    asked, known = _dense_test(spark, folder)
    found = knn.approximate_top_k(asked, known, exclude_self=True)
    exact = knn.top_k(asked, known, dense=True, exclude_self=True)
    return knn.recall(found, exact).select("n_queries", "n_neighbours", (F.col("recall") >= 0.9).alias("enough"))


def _sampled(rows, split):
    test = rows.drop("label").join(split.filter("split = 'test'"), "case_id")
    return test, knn.sampled_queries(test)


@query
def query_sample(spark, folder):
    rows = views.case_features(spark, folder)
    _, asked = _sampled(rows, features.stratified_split(rows))
    return asked.select("query_id", "case_id", "no_perkara", "label", "query_text")


@query
def expected_similar(spark, folder):
    rows = views.case_features(spark, folder)
    test, asked = _sampled(rows, staged(features.stratified_split(rows), "split"))
    return knn.expected_similar(asked, test).select(
        "case_id", F.array_join("expected", "|").alias("expected")
    )


def _records(spark, folder):
    """Query records; neighbours over the whole case base, the query's own case included."""
    rows, split, vocab, vecs = _case_model(spark, folder)
    test, asked = _sampled(rows, split)
    asked = staged(asked, "asked")
    texts = asked.select("query_id", T.strip(F.lower("query_text")).alias("query_text"))
    near = knn.top_k(
        vectors.transformed(texts.filter("query_text != ''"), vocab, "query_id", "query_text"), _as_docs(vecs),
        n_queries=P.N_QUERIES,
    )
    stored = table(spark, folder, "embeddings").select(
        F.concat(F.lit("case_"), F.md5(F.col("vec_id").cast("string"))).alias("case_id"), "embedding"
    )
    has_vector = asked.select("query_id", "case_id").join(stored, "case_id")
    dense = knn.top_k(
        has_vector, stored.withColumnRenamed("case_id", "doc_id"), dense=True,
        n_queries=P.N_QUERIES,
    )
    return knn.query_records(asked, knn.expected_similar(asked, test), near, dense)


@query
def query_records(spark, folder):
    lists = ("expected_similar_case_ids", "top5_tfidf", "top5_bert")
    df = _records(spark, folder)
    return df.select(*(F.array_join(c, "|").alias(c) if c in lists else c for c in df.columns))


# --- solution reuse ----------------------------------------------------------------------------------


@query
def vote_majority(spark, folder):
    return reuse.choose_solution(*_train_neighbours(spark, folder), "majority")


@query
def vote_weighted(spark, folder):
    return reuse.choose_solution(*_train_neighbours(spark, folder), "weighted")


@query
def predict_batch(spark, folder):
    asked, near = _train_neighbours(spark, folder)
    return reuse.predictions(asked, staged(near, "neighbours"))


# --- classifiers --------------------------------------------------------------------------------------


def _nb(spark, folder):
    rows, _, vocab, vecs = _case_model(spark, folder)
    train, test = vecs.filter("split = 'train'"), vecs.filter("split = 'test'")
    scale = staged(classify.scaling(train, vocab), "scale")
    terms, priors = classify.nb_fit(train, vocab, scale)
    return rows, test, scale, staged(terms, "terms"), staged(priors, "priors")


@query
def scale_minmax(spark, folder):
    scale = _nb_scale(spark, folder)
    return scale.select("idx", F.round("low", 6).alias("low"), F.round("range", 6).alias("range"))


def _nb_scale(spark, folder):
    _, _, vocab, vecs = _case_model(spark, folder)
    return classify.scaling(vecs.filter("split = 'train'"), vocab)


@query
def nb_model(spark, folder):
    terms = _nb(spark, folder)[3]
    return terms.select("idx", "label", F.round("logp", 6).alias("logp"))


def _nb_predictions(spark, folder):
    rows, test, _, terms, priors = _nb(spark, folder)
    pred = classify.nb_predict(test, terms, priors)
    truth = test.select("case_id", F.col("label").alias("true_label"))
    return rows, staged(truth.join(pred, "case_id"), "predictions")


@query
def nb_predict(spark, folder):
    return _nb_predictions(spark, folder)[1].select(
        "case_id", "true_label", "pred_label", F.round("score", 4).alias("score")
    )


def _svm_predictions(spark, folder):
    rows, _, vocab, vecs = _case_model(spark, folder)
    return rows, _svm_labels(vocab, vecs)


def _svm_fit(vocab, vecs):
    names = staged(features.classes(vecs), "classes")
    return names, linear.fit(vecs.filter("split = 'train'"), names, vocab.count())


def _svm_labels(vocab, vecs):
    """(case_id, true_label, pred_label) of the test rows, written once."""
    names, model = _svm_fit(vocab, vecs)
    test = vecs.filter("split = 'test'")
    truth = test.select("case_id", F.col("label").alias("true_label"))
    return staged(truth.join(linear.predict(model.weights, test, names), "case_id"), "svm-labels")


@query
def svm_predict(spark, folder):
    return _svm_predictions(spark, folder)[1]


@query
def svm_metrics(spark, folder):
    return evaluate.classification_metrics(_svm_predictions(spark, folder)[1], "TF-IDF + SVM")


@query
def svm_errors(spark, folder):
    rows, pred = _svm_predictions(spark, folder)
    return evaluate.errors(pred, rows).withColumnRenamed("pred_label", "pred_label_svm")


@query
def svm_error_profile(spark, folder):
    rows, pred = _svm_predictions(spark, folder)
    return evaluate.error_profile(staged(evaluate.errors(pred, rows), "errors"))


@query
def svm_objective(spark, folder):
    """The least objective of each class, and how many train rows it has."""
    _, _, vocab, vecs = _case_model(spark, folder)
    names, model = _svm_fit(vocab, vecs)
    found = list(enumerate(round(float(v), 4) for v in model.objective))
    least = spark.createDataFrame(found, "code int, objective double")
    n = vecs.filter("split = 'train'").groupBy("label").agg(F.count("*").alias("n_train"))
    return names.join(least, "code").join(n, "label", "left").select("label", "objective", F.coalesce("n_train", F.lit(0)).alias("n_train"))


@query
def svm_quality(spark, folder):
    """Test rows, classes, and whether the SVM is right more often than the largest class is."""
    pred = _svm_predictions(spark, folder)[1]
    largest = pred.groupBy("true_label").agg(F.count("*").alias("n")).agg(
        F.max("n").alias("largest"), F.count("*").cast("long").alias("n_classes")
    )
    right = pred.agg(F.count("*").alias("n_test"), F.count_if(F.col("true_label") == F.col("pred_label")).alias("right"))
    return right.crossJoin(largest).select("n_test", "n_classes", (F.col("right") > F.col("largest")).alias("beats_majority"))


# --- evaluation -----------------------------------------------------------------------------------------


@query
def clf_metrics(spark, folder):
    return evaluate.classification_metrics(_nb_predictions(spark, folder)[1], "Naive Bayes")


@query
def clf_report(spark, folder):
    return evaluate.classification_report(_nb_predictions(spark, folder)[1])


@query
def confusion(spark, folder):
    return evaluate.confusion(_nb_predictions(spark, folder)[1])


def _errors(spark, folder):
    rows, pred = _nb_predictions(spark, folder)
    return evaluate.errors(pred, rows)


@query
def errors(spark, folder):
    return _errors(spark, folder)


@query
def error_profile(spark, folder):
    return evaluate.error_profile(staged(_errors(spark, folder), "errors"))


def _sparse_at_k(vecs):
    asked = _as_queries(vecs).select("query_id", "label")
    known = _as_docs(vecs).select("doc_id", "label")
    return evaluate.retrieval_at_k(asked, _test_neighbours(vecs), known, "TF-IDF + Cosine")


def _dense_at_k(spark, folder):
    asked, known = _dense_test(spark, folder)
    near = knn.top_k(asked, known, dense=True, exclude_self=True)
    return evaluate.retrieval_at_k(asked, near, known, "Dense + Cosine")


@query
def retrieval_at_k(spark, folder):
    sparse = _sparse_at_k(_case_model(spark, folder)[3])
    return sparse.unionByName(_dense_at_k(spark, folder))


@query
def query_hits(spark, folder):
    return evaluate.query_hits(_records(spark, folder))


@query
def hit_rate(spark, folder):
    return evaluate.hit_rates(evaluate.query_hits(_records(spark, folder)))


def _comparison(spark, folder, with_svm=False):
    rows, _, vocab, vecs = _case_model(spark, folder)
    train, test = vecs.filter("split = 'train'"), vecs.filter("split = 'test'")
    scale = staged(classify.scaling(train, vocab), "scale")
    terms, priors = (staged(t, "nb") for t in classify.nb_fit(train, vocab, scale))
    truth = test.select("case_id", F.col("label").alias("true_label"))
    pred = truth.join(classify.nb_predict(test, terms, priors), "case_id")
    classified = [evaluate.classification_metrics(pred, "Naive Bayes")]
    if with_svm:
        classified.insert(0, evaluate.classification_metrics(_svm_labels(vocab, vecs), "TF-IDF + SVM"))
    return evaluate.model_comparison(
        classified,
        [_sparse_at_k(vecs), _dense_at_k(spark, folder)],
    )


@query
def model_comparison(spark, folder):
    return _comparison(spark, folder)


@query
def f1_series(spark, folder):
    return evaluate.f1_series(_comparison(spark, folder))


@query
def model_comparison_svm(spark, folder):
    """The comparison with the SVM as its fourth model."""
    return _comparison(spark, folder, with_svm=True)


@query
def f1_series_svm(spark, folder):
    return evaluate.f1_series(_comparison(spark, folder, with_svm=True))


# --- sources and sinks ---------------------------------------------------------------------------------------


def _new_folder(spark):
    return own_folder(spark, "out")


@query
def stored_csv(spark, folder):
    """Metadata written as CSV and read under its schema (SNK-1, SRC-2)."""
    path, schema = _new_folder(spark), "case_id string, no_perkara string, jumlah_kata int, keutuhan_teks double"
    meta = views.metadata(spark, folder).select("case_id", "no_perkara", "jumlah_kata", "keutuhan_teks")
    writers.csv(meta, path)
    return readers.csv(spark, path, schema).fillna("", ["no_perkara"])


@query
def stored_texts(spark, folder):
    """Documents written as one file each, some of them empty, and read back (SRC-1)."""
    path = _new_folder(spark)
    text = F.when(F.col("doc_id") % 9 == 0, "").otherwise(F.coalesce("text", F.lit("")))
    writers.texts(views.documents(spark, folder).select(F.col("doc_id").cast("string").alias("case_id"), text.alias("text")), path)
    return readers.corpus(spark, path)


@query
def stored_report(spark, folder):
    """All quality checks as one report file, read back in order (SNK-3)."""
    meta, missing, copies = _missing_and_copies(spark, folder)
    missing, copies = staged(missing, "missing"), staged(copies, "copies")
    short, low = quality.short_documents(meta), quality.incomplete_documents(meta)
    lines = quality.report_lines(
        documents=quality.counts(meta),
        inventories=quality.inventory_sizes(views.inventories(spark, folder)),
        missing=missing.groupBy("inventory").agg(F.count("*").alias("n")),
        short=short.groupBy("kind").agg(F.count("*").alias("n")),
        incomplete=low.agg(F.count("*").alias("n")),
        duplicates=copies.agg(F.count("*").alias("n")),
        categories=quality.categories(meta),
        verdict=quality.verdict(quality.issues(meta, missing, copies)),
    )
    path = _new_folder(spark)
    writers.report(lines, path)
    return readers.report(spark, path)


@query
def stored_queries(spark, folder):
    """Query records written as JSON lines and read back (SNK-2, SRC-3)."""
    path = _new_folder(spark)
    writers.json(_records(spark, folder), path)
    lists = ("expected_similar_case_ids", "top5_tfidf", "top5_bert")
    df = readers.query_set(spark, path, lines=True)
    return df.select(*(F.array_join(c, "|").alias(c) if c in lists else c for c in df.columns))


@query
def stored_tokens(spark, folder):
    """Token lists written as JSON arrays and read back (SNK-2)."""
    path = _new_folder(spark)
    rows = views.documents(spark, folder).select(
        F.col("doc_id").cast("string").alias("case_id"), T.tokens(F.col("text")).alias("tokens")
    )
    writers.token_lists(rows, path)
    return readers.token_table(spark, path).select("case_id", F.array_join("tokens", " ").alias("tokens"))


@query
def stored_embeddings(spark, folder):
    """Stored vectors of the cases that have one; none would be read were one missing (SRC-4)."""
    path = _new_folder(spark)
    rows = _vectors(spark, folder).select(F.col("vec_id").cast("string").alias("case_id"), "embedding")
    rows.write.parquet(path)
    some = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("case_id"))
    some = some.join(rows.select("case_id"), "case_id", "left_semi")
    return readers.embeddings(spark, path, some).select("case_id", F.size("embedding").alias("n"))


@query
def stored_model(spark, folder):
    """Naive Bayes predictions from the stored tables of a fitted model (SNK-4)."""
    path = _new_folder(spark)
    rows, split, vocab, vecs = _case_model(spark, folder)
    train = vecs.filter("split = 'train'")
    terms, priors = classify.nb_fit(train, vocab, staged(classify.scaling(train, vocab), "scale"))
    tables = (vocab, split, features.classes(rows), terms, priors)
    writers.fitted(path, dict(zip(readers.FITTED, tables)))
    stored = readers.fitted(spark, path)
    test = rows.join(stored["split"].filter("split = 'test'").select("case_id"), "case_id")
    asked = vectors.transformed(test, stored["vocabulary"], "case_id", "text_combined")
    pred = classify.nb_predict(asked, stored["nb_terms"], stored["nb_priors"])
    return pred.select("case_id", "pred_label", F.round("score", 4).alias("score"))


# --- incremental -------------------------------------------------------------------------------------------


@query
def incremental_new(spark, folder):
    known = table(spark, folder, "labels").select("doc_id")
    return unrecorded(table(spark, folder, "documents"), known, "doc_id").select("doc_id", "source")


@query
def incremental_stream(spark, folder):
    """Documents that arrive in two drops, processed by a stream that is started again after each, and once replayed.

    The second drop holds all documents, those of the first again; its batch is then repeated as after a
    failure.  One record per document remains.
    """
    path = _new_folder(spark)
    rows = table(spark, folder, "documents").select("doc_id", "source")
    known = rows.join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    schema, source, target = "doc_id long, source string", f"{path}/drops", f"{path}/records"
    for drop in (known, rows):
        drop.write.mode("append").parquet(source)
        run_available(spark, source, schema, target, id_col="doc_id")
    forget_last_commit(spark, f"{target}/_state")
    run_available(spark, source, schema, target, id_col="doc_id")
    done = spark.read.parquet(target)
    return done.groupBy("doc_id", "source").agg(
        F.count("*").alias("n_records"), F.min("batch_id").cast("long").alias("batch")
    )
