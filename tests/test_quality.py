from caselode import profile as P
from caselode.operators import quality

META = (
    "case_id string, no_perkara string, jumlah_kata int, keutuhan_teks double, "
    "valid_min_200_kata boolean, jenis_perkara string"
)


def meta(spark):
    return spark.createDataFrame(
        [
            ("a", "k", 200, 0.9, True, P.CASE_KIND), ("b", "k", 0, 0.0, False, P.CASE_KIND),
            ("c", "", 50, 0.3, False, "SENJATA API lama"), ("d", None, 400, 1.0, True, None),
        ],
        META,
    )


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "case_id string")


def test_flags_and_issues(spark):
    df = meta(spark)
    missing = quality.missing_from(df, {"raw": ids(spark, "a"), "tokens": ids(spark, "x")})
    copies = quality.duplicated_rows(df)
    flags = {r.case_id: r.alasan_perlu_dicek for r in quality.flags(df, missing, copies).collect()}
    assert flags == {
        "a": "file_token_hilang;nomor_perkara_duplikat",
        "b": "dokumen_kosong;nomor_perkara_duplikat",
        "c": "keutuhan_di_bawah_80persen",
        "d": "file_raw_hilang;file_token_hilang",
    }
    issues = quality.issues(df, missing, copies)
    assert {r.issue: r.n for r in issues.collect()} == {
        "valid_below_required": 2, "valid_without_text": 1, "valid_without_tokens": 2,
        "duplicated_key_rows": 2, "retired_category_rows": 1,
    }
    assert quality.verdict(issues).first().verdict == "NEEDS_ATTENTION"


def test_measures(spark):
    df = meta(spark)
    assert quality.counts(df).first().status == "FAIL"
    d = quality.distribution(df, "jumlah_kata").first()
    assert (d["mean"], d["median"], d["min"], d["max"]) == (162.5, 125.0, 0.0, 400.0)
    assert {r.case_id: r.kind for r in quality.short_documents(df).collect()} == {"b": "empty", "c": "short"}
    assert [r.case_id for r in quality.incomplete_documents(df).collect()] == ["c"]
    rates = {r.column_name: (r.n_empty, r.status) for r in quality.missing_rates(df, ["no_perkara", "case_id"]).collect()}
    assert rates == {"no_perkara": (2, "WARN"), "case_id": (0, "OK")}


def test_one_key_for_a_third_of_the_rows(spark):
    rows = [(f"c{i}", "hot" if i % 3 == 0 else f"k{i}", 1, 1.0, True, "x") for i in range(300)]
    got = quality.duplicated_rows(spark.createDataFrame(rows, META)).collect()
    assert len(got) == 100 and {r.n_copies for r in got} == {100}


def test_sample_keeps_rows_without_text(spark):
    texts = spark.createDataFrame([("a", "x\ny z")], "case_id string, normalised string")
    got = {r.case_id: r for r in quality.previews(quality.drawn(meta(spark)), texts).collect()}
    assert got["a"].preview == "x y z" and got["a"].n_words == 3
    assert got["d"].text_missing and got["d"].n_words is None
