"""Round trips through the sinks and scans."""

import json

from caselode.operators import quality
from caselode.sources import readers, schemas, writers


def test_corpus_and_token_files(spark, tmp_path):
    (tmp_path / "case_a-1.txt").write_text("satu\ndua é")
    (tmp_path / "case_b.txt").write_text("tiga")
    (tmp_path / "case_b.json").write_text(json.dumps(["satu", "é"]))
    texts = {r.case_id: r.text for r in readers.corpus(spark, str(tmp_path)).collect()}
    assert texts["case_a-1"] == "satu\ndua é" and texts["case_b"] == "tiga"
    assert {r.case_id for r in readers.inventory(spark, str(tmp_path), ".txt").collect()} == {"case_a-1", "case_b"}
    assert readers.token_lists(spark, str(tmp_path)).first().tokens == ["satu", "é"]


def test_csv_round_trip(spark, tmp_path):
    rows = [("q1", 'kata "kutip", koma\nbaris dua', "a|b"), ("q2", "", "é")]
    df = spark.createDataFrame(rows, schemas.PREDICTIONS)
    writers.csv(df, str(tmp_path / "p"))
    back = readers.csv(spark, str(tmp_path / "p"), schemas.PREDICTIONS).orderBy("query_id").collect()
    assert [(r[0], r[1] or "", r[2]) for r in back] == rows
    writers.csv(df, str(tmp_path / "bom"), bom=True)
    parts = [p.read_bytes() for p in (tmp_path / "bom").glob("part-*")]
    assert all(p.startswith(b"\xef\xbb\xbfquery_id,") for p in parts if p)


def test_query_records_as_lines_and_as_array(spark, tmp_path):
    record = {
        "query_id": "q", "case_id": "c", "no_perkara": "1", "decision_type": "x", "query_text": "é",
        "ground_truth_case_id": "c", "expected_similar_case_ids": ["a"], "top5_tfidf": ["c", "a"], "top5_bert": [],
    }
    (tmp_path / "a.json").write_text(json.dumps([record], ensure_ascii=False))
    df = readers.query_set(spark, str(tmp_path / "a.json"))
    assert df.first().asDict() == record
    writers.json(df.union(df).coalesce(1), str(tmp_path / "out"))
    assert "é" in next((tmp_path / "out").glob("part-*.json")).read_text()
    assert [r.asDict() for r in readers.query_set(spark, str(tmp_path / "out"), lines=True).collect()] == [record] * 2


def test_token_lists_round_trip(spark, tmp_path):
    rows = [("a", ["satu", "é", '"']), ("b", [])]
    writers.token_lists(spark.createDataFrame(rows, schemas.TOKENS), str(tmp_path / "t"))
    got = readers.token_table(spark, str(tmp_path / "t")).orderBy("case_id").collect()
    assert [(r.case_id, r.tokens) for r in got] == rows


def test_embeddings_only_when_complete(spark, tmp_path):
    vecs = spark.createDataFrame([("a", [1.0]), ("b", [2.0]), ("x", [3.0])], schemas.EMBEDDINGS)
    vecs.write.parquet(str(tmp_path / "e"))
    cases = spark.createDataFrame([("a",), ("b",)], "case_id string")
    assert readers.embeddings(spark, str(tmp_path / "e"), cases).count() == 2
    more = cases.union(spark.createDataFrame([("c",)], "case_id string"))
    assert readers.embeddings(spark, str(tmp_path / "e"), more).count() == 0


def test_report_is_one_ordered_file(spark, tmp_path):
    a = spark.createDataFrame([(3, "OK"), (12, None)], "n long, status string")
    writers.report(quality.report_lines(counts=a, again=a), str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("part-*"))) == 1
    want = ["== counts ==", "n: 12, status: -", "n: 3, status: OK", "== again ==", "n: 12, status: -", "n: 3, status: OK"]
    assert [(r.line, r.value) for r in readers.report(spark, str(tmp_path / "r")).collect()] == list(enumerate(want, 1))


def test_text_files_with_empty_ones(spark, tmp_path):
    rows = [("a", "satu\r\ndua\n"), ("b", ""), ("c", None), ("d e%+", "é"), ("f", "\n")]
    folder = str(tmp_path / "texts")
    assert writers.texts(spark.createDataFrame(rows, "case_id string, text string").repartition(3), folder) == 5
    got = {r.case_id: r.text for r in readers.corpus(spark, folder).collect()}
    assert got == {i: t or "" for i, t in rows}
    assert writers.texts(spark.createDataFrame([("a", "neu")], "case_id string, text string"), folder) == 1
    assert {r.case_id: r.text for r in readers.corpus(spark, folder).collect()} == {**got, "a": "neu"}


def test_tables_in_buckets_meet_without_moving_the_texts(spark, tmp_path):
    from caselode.operators import represent

    meta = spark.range(40).selectExpr("'c' || id AS case_id", "id % 3 <> 0 AS valid_min_200_kata")
    texts = spark.range(5, 50).selectExpr("'c' || id AS case_id", "CASE WHEN id % 7 = 0 THEN '' ELSE 't' || id END AS normalised")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as if both were large
    try:
        writers.bucketed(meta, "some_meta", str(tmp_path / "meta"), buckets=4)
        writers.bucketed(texts, "some_texts", str(tmp_path / "texts"), buckets=4)
        joined = represent.valid_with_text(readers.bucketed(spark, "some_meta"), readers.bucketed(spark, "some_texts"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert {r.case_id for r in joined.collect()} == {f"c{i}" for i in range(5, 40) if i % 3 and i % 7}
    finally:
        spark.conf.set(key, before)
        for name in ("some_meta", "some_texts"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
