"""Split, vectors, neighbours, votes, classifiers and metrics against brute force."""

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselode.operators import classify, evaluate, features, inverted, knn, linear, reuse, vectors


def labelled(spark, **sizes):
    rows = [(f"{label}{i:03d}", label) for label, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "case_id string, label string")


def test_quotas_by_largest_remainder(spark):
    rows = labelled(spark, dikabulkan=23, ditolak=58, lainnya=9)
    for parts in (1, 7):
        split = features.stratified_split(rows.repartition(parts)).collect()
        assert Counter(r.label for r in split if r.split == "test") == {
            "dikabulkan": 5, "ditolak": 11, "lainnya": 2,
        }
        assert len(split) == 90


def test_a_single_member_turns_stratification_off(spark):
    rows = labelled(spark, a=20, b=1)
    quotas = features.class_quotas(features.class_sizes(rows)).collect()
    assert not any(r.stratified for r in quotas)
    split = features.stratified_split(rows).collect()
    assert sum(r.split == "test" for r in split) == 5 and len(split) == 21


def test_split_takes_the_smallest_hashes(spark):
    import hashlib

    rows = labelled(spark, a=3000, b=40)
    test = {r.case_id for r in features.stratified_split(rows).collect() if r.split == "test"}
    for label, n in (("a", 600), ("b", 8)):
        ids = [f"{label}{i:03d}" for i in range(3000 if label == "a" else 40)]
        ids.sort(key=lambda i: (hashlib.md5(f"{i}:42".encode()).hexdigest(), i))
        assert {i for i in test if i.startswith(label)} == set(ids[:n])


def test_label_codes_are_alphabetical(spark):
    got = features.label_codes(labelled(spark, z=1, b=2, m=1)).collect()
    assert {r.label: r.label_encoded for r in got} == {"b": 0, "m": 1, "z": 2}


def test_any_number_of_classes(spark):
    rows = spark.range(10_001).select(F.col("id").cast("string").alias("label"))
    got = {r.label: r.label_encoded for r in features.label_codes(rows).collect()}
    assert got == {label: n for n, label in enumerate(sorted(got))} and len(got) == 10_001


WORDS = "satu dua tiga empat lima enam tujuh Perkara Gugatan été x".split()


def texts(n, seed=1):
    rng = random.Random(seed)
    return [" ".join(rng.choices(WORDS, k=rng.randint(0, 30))) for _ in range(n)]


def plain_tfidf(docs, max_features):
    def terms(t):
        w = re.findall(r"\b\w\w+\b", t.lower())
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    counts = [Counter(terms(t)) for t in docs]
    df, cf = Counter(), Counter()
    for c in counts:
        df.update(c.keys())
        cf.update(c)
    kept = sorted((t for t in df if df[t] >= 2), key=lambda t: (-cf[t], t))[:max_features]
    vocab = {t: i for i, t in enumerate(sorted(kept))}
    m = np.zeros((len(docs), len(vocab)))
    for row, c in enumerate(counts):
        for t, n in c.items():
            if t in vocab:
                m[row, vocab[t]] = (1 + math.log(n)) * (math.log((1 + len(docs)) / (1 + df[t])) + 1)
        if m[row].any():
            m[row] /= np.linalg.norm(m[row])
    return vocab, m


def table(spark, docs):
    return spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")


@pytest.mark.parametrize("parts", [1, 6])
def test_tfidf_equals_the_matrix(spark, parts):
    docs = texts(60) + ["", "x"]
    vocab, m = plain_tfidf(docs, 40)
    df = table(spark, docs).repartition(parts)
    counts = vectors.term_counts(df, "doc_id", "text")
    v = vectors.vocabulary(counts, len(docs), max_features=40)
    assert {r.term: r.idx for r in v.collect()} == vocab
    got = np.zeros_like(m)
    rows = vectors.vectors(counts, v, "doc_id").collect()
    for r in rows:
        got[r.doc_id, r.indices] = r["values"]
    assert len(rows) == len(docs) and np.allclose(got, m)


@pytest.mark.parametrize("min_df", [1, 2, 3])
def test_fitted_vectors_equal_those_of_all_counts(spark, min_df):
    rows = [(i % 30, t) for i, t in enumerate(texts(50) + ["", "x", "dua kata", None, "kata kata kata"])]
    rows += [(None, "satu tanpa nomor"), (None, "satu tanpa nomor lagi"), (None, None), (77, "hanya di sini hanya di sini")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    counts = vectors.term_counts(df, "doc_id", "text")
    want = vectors.vocabulary(counts, len(rows), min_df, 40)
    vocab, vecs = vectors.fitted(df, "doc_id", "text", len(rows), min_df, 40)
    columns = ["term", "idx", "df", "cf", "idf"]
    assert sorted(map(tuple, vocab.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))

    def by_id(found):
        return {r.doc_id: (r.indices, [round(x, 12) for x in r["values"]]) for r in found.collect()}

    old = by_id(vectors.vectors(counts, want, "doc_id"))
    assert vecs.count() == len(old) == 32 and by_id(vecs) == old
    assert by_id(vectors.transformed(df, vocab, "doc_id", "text")) == old


def test_terms_outside_the_vocabulary_are_not_shuffled(spark):
    df = table(spark, texts(60))
    vocab, vecs = vectors.fitted(df, "doc_id", "text", 60, max_features=5)
    plan = vectors.known_terms(df, vocab, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # the texts
    # no exchange behind the counts
    assert "Exchange hashpartitioning" not in vecs._jdf.queryExecution().executedPlan().toString()


def brute_top(sims, k, skip_self):
    out = {}
    for q, row in enumerate(np.round(sims, 9)):
        order = sorted((d for d in range(len(row)) if not (skip_self and d == q)), key=lambda d: (-row[d], d))
        out[q] = order[:k]
    return out


def ranked(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.doc_id
    return {q: [ids[i] for i in sorted(ids)] for q, ids in got.items()}


@pytest.mark.parametrize("skip_self", [False, True])
def test_sparse_neighbours_across_blocks(spark, monkeypatch, skip_self):
    monkeypatch.setattr(knn, "QUERY_BLOCK", 16)
    monkeypatch.setattr(knn, "DOC_BLOCK", 11)
    monkeypatch.setattr(knn, "SLICE", 3)
    docs = texts(50) + ["satu dua tiga"] * 25 + [""]  # a third are copies
    _, m = plain_tfidf(docs, 10_000)
    df = table(spark, docs)
    counts = vectors.term_counts(df, "doc_id", "text")
    vecs = vectors.vectors(counts, vectors.vocabulary(counts, df.count()), "doc_id")
    near = knn.top_k(vecs.withColumnRenamed("doc_id", "query_id"), vecs, exclude_self=skip_self)
    assert ranked(near) == brute_top(m @ m.T, 5, skip_self)


def test_dense_neighbours_and_short_corpus(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30, 8))
    x[7] = 0
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "doc_id long, embedding array<float>")
    unit = x.astype(np.float32).astype(float)
    n = np.linalg.norm(unit, axis=1, keepdims=True)
    unit = np.divide(unit, n, out=np.zeros_like(unit), where=n > 0)
    asked = rows.withColumnRenamed("doc_id", "query_id")
    assert ranked(knn.top_k(asked, rows, dense=True)) == brute_top(unit @ unit.T, 5, False)
    few = rows.filter("doc_id < 3")
    assert ranked(knn.top_k(asked, few, dense=True, exclude_self=True))[0] == brute_top(
        unit[:3] @ unit[:3].T, 5, True
    )[0]


def test_expected_similar_is_cut_per_label(spark):
    test = labelled(spark, a=9, b=1)
    got = {r.case_id: r.expected for r in knn.expected_similar(test, test).collect()}
    assert got["a000"] == [f"a00{i}" for i in range(1, 6)]
    assert got["a008"] == [f"a00{i}" for i in range(5)] and got["b000"] == []


VOTES = [
    ("count", "A", 0.1, 1), ("count", "B", 0.9, 2), ("count", "A", 0.1, 3),
    ("tie", "B", 0.4, 1), ("tie", "A", 0.5, 2),
    ("even", "Z", 0.3, 1), ("even", "A", 0.3, 2),
    ("blank", " ", 0.9, 1), ("blank", "C", 0.1, 2),
    ("none", "", 0.9, 1), ("none", None, 0.8, 2),
    ("minus", "A", -0.5, 1), ("minus", "B", -0.6, 2),
]


def test_votes(spark):
    rows = spark.createDataFrame(
        [(q, f"d{i}", s, r, sol) for i, (q, sol, s, r) in enumerate(VOTES)],
        "query_id string, doc_id string, sim double, rank int, solution string",
    )
    asked = spark.createDataFrame([(q,) for q in ("count", "tie", "even", "blank", "none", "minus", "absent")], "query_id string")

    def chosen(strategy):
        return {r.query_id: r.predicted_solution for r in reuse.choose_solution(asked, rows, strategy).collect()}

    common = {"tie": "A", "even": "Z", "blank": "C", "none": "", "minus": "A", "absent": ""}
    assert chosen("majority") == {"count": "A", **common}
    assert chosen("weighted") == {"count": "B", **common}
    batch = {r.query_id: r.top_5_case_ids for r in reuse.predictions(asked, rows).collect()}
    assert batch["count"] == "d0|d1|d2" and batch["absent"] == ""


def model_rows(spark):
    """Train and test vectors with one term in all train rows, one in none of them."""
    rng = np.random.default_rng(5)
    x = np.where(rng.random((40, 6)) < 0.5, rng.random((40, 6)), 0)
    x[:, 0] = rng.random(40) + 0.1
    x[:30, 5] = 0
    x[35, 0] = 0
    y = np.where(x[:, 1] > x[:, 2], "a", "b")
    rows = [
        (f"c{i:02d}", y[i].item(), "train" if i < 30 else "test",
         [int(j) for j in np.flatnonzero(x[i])], [float(v) for v in x[i][x[i] > 0]])
        for i in range(40)
    ]
    schema = "case_id string, label string, split string, indices array<int>, values array<double>"
    return x, y, spark.createDataFrame(rows, schema)


def test_naive_bayes_equals_the_dense_form(spark):
    x, y, rows = model_rows(spark)
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    vocab = spark.range(6).select(F.col("id").cast("int").alias("idx"))
    scale = classify.scaling(train, vocab)
    terms, priors = classify.nb_fit(train, vocab, scale)
    got = {r.case_id: (r.pred_label, r.score) for r in classify.nb_predict(test, terms, priors).collect()}

    low, high = x[:30].min(0), x[:30].max(0)
    z = (x - low) / np.where(high == low, 1, high - low)
    scores = []
    for c in "ab":
        mass = z[:30][y[:30] == c].sum(0) + 0.1
        scores.append(math.log((y[:30] == c).mean()) + z[30:] @ np.log(mass / mass.sum()))
    best = np.argmax(scores, 0)
    for i in range(10):
        label, score = got[f"c{30 + i}"]
        assert label == "ab"[best[i]] and abs(score - scores[best[i]][i]) < 1e-5


def plain_svm(rows, n_features, c):
    """(weights, objective) of one class against the rest: damped Newton steps on dense rows."""
    x = np.zeros((len(rows), n_features + 1))
    for k, (indices, values, _) in enumerate(rows):
        x[k, indices], x[k, -1] = values, 1
    y, w = np.array([1.0 if own else -1.0 for *_, own in rows]), np.zeros(n_features + 1)
    value = lambda w: 0.5 * w @ w + c * (np.maximum(0, 1 - y * (x @ w)) ** 2).sum()
    for _ in range(200):
        room = 1 - y * (x @ w)
        on = room > 0
        gradient = w - 2 * c * x[on].T @ (y * room)[on]
        if np.linalg.norm(gradient) < 1e-11:
            break
        step = -np.linalg.solve(np.eye(len(w)) + 2 * c * x[on].T @ x[on], gradient)
        t = 1.0
        while value(w + t * step) > value(w) + 1e-4 * t * gradient @ step and t > 1e-9:
            t /= 2
        w = w + t * step
    return w, value(w)


@pytest.mark.parametrize("c", [0.01, 1.0, 100.0])
def test_svm_equals_a_plain_solver(spark, c):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(150):
        n = int(rng.integers(0, 9))
        indices = sorted(rng.choice(20, n, replace=False).tolist())
        rows.append((f"c{i:03d}", "xyz"[(sum(indices) + int(rng.integers(0, 3) == 0)) % 3], indices, rng.random(n).tolist()))
    df = spark.createDataFrame(rows, "case_id string, label string, indices array<int>, values array<double>").repartition(4)
    names = features.classes(df)
    model = linear.fit(df, names, 20, c)
    plain = [plain_svm([(i, v, label == name) for _, label, i, v in rows], 20, c) for name in "xyz"]
    assert model.objective == pytest.approx([v for _, v in plain], rel=1e-6)
    got = np.zeros((3, 21))
    for r in model.weights.collect():
        got[r.code, r.idx] = r.weight  # -1 is the last, the intercept
    assert np.abs(got - np.array([w for w, _ in plain])).max() < 1e-3 * max(1, np.abs(got).max())
    want = {}
    for case, _, i, v in rows:
        score = [round(float(np.dot(w[i], v) + w[-1]), 9) for w, _ in plain]
        want[case] = ("xyz"[int(np.argmax(score))], np.diff(np.sort(score))[-1])
    for r in linear.predict(model.weights, df, names).collect():
        assert r.pred_label == want[r.case_id][0] or want[r.case_id][1] < 1e-3


def test_svm_is_stored_and_needs_two_classes(spark, tmp_path):
    from caselode.sources import readers, writers

    _, _, rows = model_rows(spark)
    names = features.classes(rows)
    model = linear.fit(rows, names, 6, c=100.0)
    truth = rows.select("case_id", F.col("label").alias("true_label"))

    def accuracy(weights):
        pred = truth.join(linear.predict(weights, rows, names), "case_id")
        return evaluate.classification_metrics(pred, "svm").first().accuracy

    assert accuracy(model.weights) >= 0.9
    writers.fitted(str(tmp_path), {"classes": names}, model.weights)
    assert accuracy(readers.svm(spark, str(tmp_path))) == accuracy(model.weights)
    with pytest.raises(FileNotFoundError):
        readers.fitted(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        readers.svm(spark, f"{tmp_path}/none")
    one = rows.filter(F.col("label") == names.first().label)
    with pytest.raises(ValueError):
        linear.fit(one, features.classes(one), 6)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here")
def test_svm_of_the_cases_equals_a_plain_solver(spark):
    from caselode.plans import registry

    _, _, vocab, vecs = registry._case_model(spark, "/root/testdata/sf0.001")
    n = vocab.count()
    names, model = registry._svm_fit(vocab, vecs)
    rows = vecs.collect()
    order = [r.label for r in names.orderBy("code").collect()]
    plain = [plain_svm([(r.indices, r["values"], r.label == name) for r in rows if r.split == "train"], n, 1.0) for name in order]
    assert model.objective == pytest.approx([v for _, v in plain], abs=1e-4)
    got = {r.case_id: r.pred_label for r in linear.predict(model.weights, vecs.filter("split = 'test'"), names).collect()}
    for r in rows:
        if r.split == "test":
            score = [round(float(np.dot(w[r.indices], r["values"]) + w[-1]), 6) for w, _ in plain]
            assert got[r.case_id] == order[int(np.argmax(score))]


def predictions(spark, pairs):
    return spark.createDataFrame(
        [(f"c{i}", t, p) for i, (t, p) in enumerate(pairs)], "case_id string, true_label string, pred_label string"
    )


def test_metrics_with_unseen_classes(spark):
    pred = predictions(spark, [("a", "a"), ("a", "c"), ("b", "a")])
    m = evaluate.classification_metrics(pred, "x").first()
    assert (m.accuracy, m.precision, m.recall, m.f1) == (0.3333, 0.3333, 0.3333, 0.3333)
    report = {r.label: (r.precision, r.recall, r.f1, r.support) for r in evaluate.classification_report(pred).collect()}
    assert report["a"] == (0.5, 0.5, 0.5, 2) and report["b"] == (0, 0, 0, 1) and report["c"] == (0, 0, 0, 0)
    assert report["macro avg"][:3] == (0.1667, 0.1667, 0.1667)
    grid = evaluate.confusion(pred).collect()
    assert len(grid) == 9 and sum(r.n for r in grid) == 3
    wide = {r.true_label: (r.a, r.b, r.c) for r in evaluate.confusion_matrix(pred, ["a", "b", "c"]).collect()}
    assert wide == {"a": (1, 0, 1), "b": (1, 0, 0), "c": (0, 0, 0)}
    perfect = evaluate.classification_metrics(predictions(spark, [("a", "a")]), "x").first()
    assert (perfect.accuracy, perfect.f1) == (1.0, 1.0)


def test_retrieval_skips_queries_without_relevant_rows(spark):
    known = spark.createDataFrame([("a1", "a"), ("a2", "a"), ("a3", "a"), ("b1", "b")], "doc_id string, label string")
    asked = spark.createDataFrame([("a1", "a"), ("b1", "b")], "query_id string, label string")
    near = spark.createDataFrame([("a1", "a2"), ("a1", "b1"), ("b1", "a1")], "query_id string, doc_id string")
    m = evaluate.retrieval_at_k(asked, near, known, "x", k=5).first()
    assert (m.accuracy, m.precision, m.recall, m.f1) == (1.0, 0.2, 0.5, 0.2857)
    none = evaluate.retrieval_at_k(asked.filter("label = 'b'"), near, known, "x").first()
    assert (none.accuracy, none.f1) == (0.0, 0.0)


def test_hit_rates_and_comparison(spark):
    schema = (
        "query_id string, case_id string, decision_type string, ground_truth_case_id string, "
        "top5_tfidf array<string>, top5_bert array<string>"
    )
    records = spark.createDataFrame(
        [("q1", "a", "x", "a", ["b", "a"], []), ("q2", "b", "x", "b", ["b"], ["b"])], schema
    )
    rates = {r.model: (r.hit_rate, r.correct, r.total) for r in evaluate.hit_rates(evaluate.query_hits(records)).collect()}
    assert rates == {"TF-IDF Retrieval": (1.0, 2, 2), "BERT Retrieval": (0.5, 1, 2)}
    empty = evaluate.hit_rates(evaluate.query_hits(records.limit(0))).collect()
    assert {r.hit_rate for r in empty} == {0.0}
    a = spark.createDataFrame([("m", 0.5, 0.5)], "model string, accuracy double, f1 double")
    b = spark.createDataFrame([("r", 0.25)], "model string, accuracy double")
    table = evaluate.model_comparison([a], [b])
    assert {r.model: r.type for r in table.collect()} == {"m": "classification", "r": "retrieval"}
    assert {r.model: r.f1 for r in evaluate.f1_series(table).collect()} == {"m": 0.5, "r": 0.0}


def test_blank_facts_ask_with_the_full_text(spark):
    rows = [("a", "x", "facts", "whole"), ("b", "x", " \n", "whole"), ("c", "x", None, None)]
    test = spark.createDataFrame(rows, "case_id string, label string, ringkasan_fakta string, text_full string")
    got = {r.case_id: r.query_text for r in knn.sampled_queries(test).collect()}
    assert got == {"a": "facts", "b": "whole", "c": ""}
    with pytest.raises(Exception, match="text_full"):
        knn.sampled_queries(test.drop("text_full")).collect()


def sparse_rows(spark, own_id, n, seed, terms=60, copies=0):
    """Unit vectors with frequent and rare terms, some empty, some equal."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        size = int(rng.integers(0, 12))
        idx = sorted({int(terms * rng.random() ** 3) for _ in range(size)})
        value = rng.random(len(idx)) + 0.05
        rows.append((f"{own_id[0]}{i:04d}", idx, (value / np.linalg.norm(value)).tolist() if idx else []))
    rows += [(f"{own_id[0]}{n + i:04d}", *rows[7][1:]) for i in range(copies)]
    return spark.createDataFrame(rows, f"{own_id} string, indices array<int>, values array<double>").repartition(3)


@pytest.mark.parametrize("k, probes", [(5, 256), (1, 8), (40, 0)])
def test_inverted_lists_equal_the_block_product(spark, monkeypatch, k, probes):
    monkeypatch.setattr(inverted, "PROBES", probes)
    asked, known = sparse_rows(spark, "query_id", 60, 1), sparse_rows(spark, "doc_id", 300, 2, copies=30)
    rows = lambda df: sorted((r.query_id, r["rank"], r.doc_id, round(r.sim, 8)) for r in df.collect())
    assert rows(inverted.top_k(asked, known, k)) == rows(knn.top_k(asked, known, k))
    own = known.withColumnRenamed("doc_id", "query_id")
    assert rows(inverted.top_k(own, known, k, exclude_self=True)) == rows(knn.top_k(own, known, k, exclude_self=True))


def test_inverted_lists_compare_few_pairs_without_python(spark):
    asked, known = sparse_rows(spark, "query_id", 50, 3, terms=3000), sparse_rows(spark, "doc_id", 1000, 4, terms=3000)
    near = inverted.top_k(asked, known)
    assert "Python" not in near._jdf.queryExecution().toString() and "Arrow" not in near._jdf.queryExecution().toString()
    posted = inverted.postings(known.withColumnRenamed("doc_id", "d"))
    terms = posted.groupBy("idx").agg(F.count("*").alias("df"))
    lists = asked.select(F.col("query_id").alias("q"), F.inline(F.arrays_zip("indices", "values")))
    lists = lists.select("q", F.col("indices").alias("idx"), F.col("values").alias("wq")).join(terms, "idx")
    floor = near.filter("rank = 5").select(F.col("query_id").alias("q"), F.col("sim").alias("floor"))
    assert inverted.candidates(lists, floor, posted).count() < 0.3 * 50 * 1000


def test_inverted_lists_shuffle_no_pairs(spark, monkeypatch):
    asked, known = sparse_rows(spark, "query_id", 40, 3), sparse_rows(spark, "doc_id", 200, 4, copies=20)
    posted = inverted.postings(known.withColumn("d", F.monotonically_increasing_id()).repartition(5, "d"))
    terms = posted.groupBy("idx").agg(F.count("*").alias("df"))
    lists = asked.select(F.col("query_id").alias("q"), F.inline(F.arrays_zip("indices", "values")))
    lists = lists.select("q", F.col("indices").alias("idx"), F.col("values").alias("wq")).join(terms, "idx")
    floor = lists.select("q", F.lit(0.3).alias("floor")).distinct()
    pairs = inverted.candidates(lists, floor, posted)
    pairs.count()
    assert "hashpartitioning(q#" not in pairs._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    # blocks of queries, one after the other, give what one block gives
    monkeypatch.setattr(inverted, "BLOCK_TERMS", 30, raising=False)
    rows = lambda df: sorted((r.query_id, r["rank"], r.doc_id, round(r.sim, 8)) for r in df.collect())
    assert rows(inverted.top_k(asked, known)) == rows(knn.top_k(asked, known))


def test_projections_lay_out_no_pairs(spark):
    rows = [(i, [1.0, 2.0, 0.5] if i % 2 else [float(i + 1), -1.0, 3.0]) for i in range(300)]
    known = spark.createDataFrame(rows, "doc_id long, embedding array<double>")
    asked = known.filter("doc_id < 9").withColumnRenamed("doc_id", "query_id")
    found = knn.approximate_top_k(asked, known, exclude_self=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "HashAggregate" not in plan
    of_copies = [r.doc_id for r in found.filter("query_id = 3").orderBy("rank").collect()]
    assert of_copies == [1, 5, 7, 9, 11]
    # rows that come twice are one
    twice = knn.approximate_top_k(asked.union(asked), known.union(known), exclude_self=True)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, found.collect()))


def test_projections_find_most_neighbours(spark):
    rng = np.random.default_rng(5)
    spots = rng.normal(size=(40, 16))
    rows = [(i, (spots[i % 40] + 0.3 * rng.normal(size=16)).tolist()) for i in range(600)] + [(600, [0.0] * 16), (601, None)]
    known = spark.createDataFrame(rows, "doc_id long, embedding array<double>")
    asked = known.filter("doc_id % 6 = 0 AND doc_id < 600").withColumnRenamed("doc_id", "query_id")
    exact = knn.top_k(asked, known.filter("embedding IS NOT NULL"), dense=True, exclude_self=True)
    found = knn.approximate_top_k(asked, known, exclude_self=True)
    got = knn.recall(found, exact).first()
    assert (got.n_queries, got.n_neighbours) == (100, 500) and got.recall >= 0.9
    few = knn.recall(knn.approximate_top_k(asked, known, exclude_self=True, bucket=0.05, tables=1), exact).first()
    assert few.recall < got.recall
    sims = {(r.query_id, r.doc_id): r.sim for r in exact.collect()}
    for r in found.collect():
        assert abs(sims.get((r.query_id, r.doc_id), r.sim) - r.sim) < 1e-6


def test_representation_decides_the_plan(spark):
    vecs = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "case_id string, embedding array<double>")
    cases = vecs.select("case_id")
    other = spark.createDataFrame([("a",), ("c",)], "case_id string")

    def chosen(cases, vecs):
        plan = lambda name: lambda: spark.createDataFrame([(name,)], "by string")
        row = knn.retrieve(cases, vecs, plan("words"), plan("vectors")).first()
        return row.by, row.method

    assert chosen(cases, vecs) == ("vectors", "dense")
    assert chosen(cases, vecs.limit(1)) == chosen(other, vecs) == chosen(cases.limit(0), vecs.limit(0)) == ("words", "sparse")


def test_solutions_fall_back_over_three_columns(spark):
    rows = [(" x ", "f", "l"), ("", " f", "l"), (None, None, "l"), (" ", "\n", " "), (None, None, None)]
    df = spark.createDataFrame(rows, "amar string, facts string, label string")
    assert [r[0] for r in df.select(reuse.solution_text("amar", "facts", "label")).collect()] == ["x", "f", "l", "", ""]


def test_neighbours_meet_without_copies(spark, monkeypatch):
    monkeypatch.setattr(knn, "QUERY_BLOCK", 8)
    monkeypatch.setattr(knn, "DOC_BLOCK", 20)
    monkeypatch.setattr(knn, "SLICE", 7)
    monkeypatch.setattr(knn, "HELD", 2, raising=False)
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(30, 8)).astype(np.float32), 2, axis=0)  # every vector comes twice
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "doc_id long, embedding array<float>")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    for limit, join in ("-1", "CartesianProduct"), ("10m", "BroadcastNestedLoopJoin"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            near = knn.top_k(rows.withColumnRenamed("doc_id", "query_id"), rows, dense=True, exclude_self=True)
            plan = near._jdf.queryExecution().toString()
            assert ranked(near) == brute_top(unit @ unit.T, 5, True)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        # blocks are read where they meet: no row is laid out once per block of the other side
        assert join in plan and "Generate" not in plan and "FlatMapCoGroups" not in plan


def test_svm_passes_send_each_sum_once(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(400):
        indices = sorted(set(np.minimum(rng.zipf(1.3, 12) - 1, 59).tolist()))
        value = rng.random(len(indices)) + 0.1
        rows.append((int(sum(indices) % 3 == 0), indices, (value / np.linalg.norm(value)).tolist()))
    df = spark.createDataFrame(rows, "code int, indices array<int>, values array<double>")
    df.repartition(4).write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    assert df.rdd.getNumPartitions() > 1
    kind, sent = type(df), []
    real = kind.toArrow
    monkeypatch.setattr(kind, "toArrow", lambda self: sent.append(real(self)) or sent[-1])
    w, objective, _, passes = linear.solve(df, 2, 60, 1.0)
    for code in (0, 1):
        plain = plain_svm([(i, v, c == code) for c, i, v in rows], 60, 1.0)
        assert objective[code] == pytest.approx(plain[1], rel=1e-6)
    # the driver gets one number per place of the model from all tasks together
    assert len(sent) == passes
    assert all(len(set(t.column("at").to_pylist())) == t.num_rows for t in sent)


def test_svm_shows_the_hessian_by_rows_that_count(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(linear, "OWN_ROWS", 150)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(3000):
        easy = i % 4 < 3  # rows with a word of their class soon count no more
        indices = sorted(set(np.minimum(rng.zipf(1.3, 8) + 1, 79).tolist()) | ({i % 2} if easy else set()))
        value = rng.random(len(indices)) + 0.1
        value[: int(easy)] += 3
        rows.append((not easy, i % 2, indices, (value / np.linalg.norm(value)).tolist()))
    df = spark.createDataFrame(rows, "hard boolean, code int, indices array<int>, values array<double>")
    df.repartition(3).sortWithinPartitions("hard").drop("hard").write.parquet(f"{tmp_path}/rows")
    w, objective, _, passes = linear.solve(spark.read.parquet(f"{tmp_path}/rows"), 2, 80, 1.0)
    for code in (0, 1):
        plain = plain_svm([(i, v, c == code) for _, c, i, v in rows], 80, 1.0)
        assert objective[code] == pytest.approx(plain[1], rel=1e-5)
    assert passes <= 100


def test_svm_passes_do_not_grow_with_tasks(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(2400):
        indices = sorted(set(np.minimum(rng.zipf(1.25, 14) - 1, 299).tolist()))
        value = rng.random(len(indices)) + 0.1
        rows.append((int(sum(indices) % 3 == 0), indices, (value / np.linalg.norm(value)).tolist()))
    df = spark.createDataFrame(rows, "code int, indices array<int>, values array<double>")
    df.repartition(8).write.parquet(f"{tmp_path}/rows")
    w, objective, steps, passes = linear.solve(spark.read.parquet(f"{tmp_path}/rows"), 2, 300, 10.0)
    # all active rows are shown at once, so a step needs few products; solutions of every task's own rows took 30 passes
    assert passes <= 20
    for code in (0, 1):
        assert objective[code] == pytest.approx(plain_svm([(i, v, c == code) for c, i, v in rows], 300, 10.0)[1], rel=1e-5)


@pytest.mark.parametrize("widths", [(0,), (3,), (64,)])
def test_few_similarities_are_found_exactly_pair_by_pair(monkeypatch, widths):
    import pyarrow as pa

    monkeypatch.setattr(knn, "MATRIX_TERMS", widths)
    monkeypatch.setattr(knn, "LAID_OUT", 500)
    rng = np.random.default_rng(2)
    x = np.zeros((640, 50))
    for row in x:
        at = np.unique(np.minimum(rng.zipf(1.3, 9) - 1, 49))
        row[at] = rng.integers(1, 4, len(at))
    x[::97] = 0  # without terms
    x[300:330] = x[5]  # copies are as near: the smaller id wins
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def table(name, ids):
        some = [np.flatnonzero(x[i]) for i in ids]
        lists = pa.array([a.tolist() for a in some], pa.list_(pa.int32())), pa.array([x[i][a].tolist() for i, a in zip(ids, some)], pa.list_(pa.float64()))
        return pa.table({name: [f"c{i:03d}" for i in ids], "indices": lists[0], "values": lists[1]})

    score, best, pairs = knn._sparse_scores(table("query_id", range(40))), None, []
    for ids in np.array_split(rng.permutation(640), 4):
        docs = table("doc_id", ids)
        found = score(docs)
        real = found.exact
        monkeypatch.setattr(found, "exact", lambda q, d, real=real: pairs.append(len(q)) or real(q, d))
        some = knn._best(docs, 6, found, knn._bound(best, 40, 6))
        best = some if best is None else knn._merged(best, some, 6)
    sims = np.round(x[:40] @ x.T, knn.DIGITS)
    want = [(q, f"c{d:03d}") for q in range(40) for d in np.lexsort((np.arange(640), -sims[q]))[:6]]
    assert list(zip(best["q"].to_pylist(), best["doc_id"].to_pylist())) == want
    assert best["sim"].to_pylist() == pytest.approx([sims[q, int(d[1:])] for q, d in want], abs=2e-9)
    # every similarity of every pair was found exactly before
    assert 0 < sum(pairs) < 0.2 * 40 * 640
