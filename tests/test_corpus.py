"""Pages, link lists, deduplication, stopping rule, incremental runs."""

from caselode.operators import corpus
from caselode.streaming import incremental


def cell(label, value):
    return f"<tr><td>{label}</td><td>{value}</td></tr>"


def test_page_records(spark):
    table = (
        '<table class="table wide"><tr><td><h2> Putusan <b>Nomor</b> 9 </h2></td></tr>'
        + cell("Nomor", " <b>9</b> / Pdt ") + cell("Amar Lainnya", "verstek") + cell("Amar", "ditolak")
        + cell("Hakim Ketua", "Sri &amp; Rekan") + "</table><!-- <td>Panitera</td><td>x</td> -->"
    )
    slug = "a" * 50
    pages = spark.createDataFrame(
        [
            (7, f"http://x/direktori/putusan/{slug}.html", table + '<a href="/pdf/9">unduh</a>'),
            (12, "http://x/lain", table),
            (13, "http://x/lain", "<table><tr><td>Nomor</td><td>1</td></tr></table>"),
        ],
        "page_id long, url string, html string",
    )
    got = {r.case_id: r for r in corpus.page_records(pages).collect()}
    assert set(got) == {"case_" + "a" * 40, "case_012"}
    r = got["case_" + "a" * 40]
    assert (r.judul, r.no_perkara, r.hakim_ketua, r.panitera) == ("PutusanNomor9", "9/ Pdt", "Sri & Rekan", "")
    assert (r.amar_lainnya, r.amar) == ("verstek", "verstek")  # the first cell that contains "Amar"
    assert r.url_pdf == "/pdf/9" and got["case_012"].url_pdf == ""


def records(spark, *tables):
    pages = spark.createDataFrame([(i, "u", t) for i, t in enumerate(tables)], "page_id long, url string, html string")
    return {int(r.case_id[5:]): r for r in corpus.page_records(pages).collect()}


def test_cells_of_nested_tables(spark):
    inner = "<TABLE class=x><tr><td>dalam</td><td> b </td></tr></TABLE>"
    got = records(
        spark,
        f'<table class="table">{cell("Kata Kunci", inner)}{cell("Nomor", "1")}</table><table>{cell("Panitera", "no")}</table>',
        f'<table class="table"><tr><td>x {inner} Nomor</td><td>2</td></tr></table>',  # the next cell begins inside
        f'<div><table><tr><td>a</td></tr></table><table class="big table"><tr><td>Nomor<td>3<tr><td>Amar<td>{inner}</table> rest',
        f'<table class="table"><tr><td>Nomor</td><td>4 {inner}',
        '<table class="table"><tr><td>Nomor</td></tr></table>',
    )
    assert (got[0].kata_kunci, got[0].no_perkara, got[0].panitera) == ("dalamb", "1", "")
    assert got[1].no_perkara == "dalam"
    assert (got[2].no_perkara, got[2].amar) == ("3", "dalamb")
    assert got[3].no_perkara == "4dalamb" and got[4].no_perkara == ""


def test_character_references(one):
    import html as library

    from caselode.functions import html

    texts = [
        "plain", "a &amp; b", "&amp;lt;", "&eacute;&Eacute;&hellip;&nbsp;x", "&#233;&#xE9;&#XE9;&#x1F600;", "&#0;&#xD800;&#1114112;",
        "&#128;&#150;&#x9F;", "&copy 2025 &lt", "&zzname; & &;&#;&#x;", "&NotEqualTilde;&fjlig;", "&#99999999999999999999;", "&#0000000065;",
    ]
    assert one(html.resolve, texts) == [library.unescape(t) for t in texts]


def test_links_stop_at_the_first_page_without_any(spark):
    def a(*urls):
        return "".join(f'<a class="k" href="{u}">x</a>' for u in urls)

    pages = spark.createDataFrame(
        [(1, a("/p/b", "/p/a", "/q/z", "/p/b")), (2, a("/p/a", "/p/c")), (3, a("/q/z")), (4, a("/p/d"))],
        "page_id long, html string",
    )
    got = corpus.listing_links(pages, "^/p/").orderBy("first_page", "first_pos").collect()
    assert [r.url for r in got] == ["/p/b", "/p/a", "/p/c"]
    assert corpus.listing_links(pages, "^/p/", limit=2).count() == 2


def test_longest_per_key(spark):
    rows = spark.createDataFrame(
        [("a", "k", 5), ("b", "k", 9), ("c", "k", 9), ("d", "", 1), ("e", None, 1), ("f", "m", 0)],
        "case_id string, no_perkara string, jumlah_kata int",
    )
    for parts in (1, 5):
        got = corpus.longest_per_key(rows.repartition(parts), "no_perkara", "jumlah_kata", "case_id")
        assert sorted(r.case_id for r in got.collect()) == ["b", "d", "e", "f"]


def until(spark, recorded, target):
    new = spark.createDataFrame(
        [(f"c{i}", i, i % 2 == 0) for i in range(10)], "case_id string, seq long, valid_min_200_kata boolean"
    )
    done = spark.createDataFrame(recorded, "case_id string, valid_min_200_kata boolean")
    got = corpus.until_enough_valid(new, done, target).collect()
    return sorted(r.seq for r in got)


def test_taking_until_enough_valid(spark):
    assert until(spark, [], 3) == [0, 1, 2, 3, 4]
    assert until(spark, [], 99) == list(range(10))
    assert until(spark, [("c0", True), ("c1", False)], 3) == [2, 3, 4]
    assert until(spark, [("c0", True), ("old", True)], 2) == []


def test_incremental_run_appends_only_new_ids(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    checkpoint = str(tmp_path / "state")
    schema = "case_id string, n long"

    def arrive(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        incremental.run_available(spark, source, schema, target, checkpoint=checkpoint)
        return sorted((r.case_id, r.n) for r in spark.read.parquet(target).collect())

    assert arrive(("a", 1), ("b", 1), ("b", 1)) == [("a", 1), ("b", 1)]
    assert arrive(("b", 2), ("c", 2)) == [("a", 1), ("b", 1), ("c", 2)]
    incremental.run_available(spark, source, schema, target, checkpoint=checkpoint)
    assert spark.read.parquet(target).count() == 3


def test_incremental_run_keeps_what_other_streams_recorded(spark, tmp_path):
    target, schema = str(tmp_path / "out"), "case_id string, n long"

    def run(folder, rows, **more):
        source = str(tmp_path / folder)
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        incremental.run_available(spark, source, schema, target, **more)
        return sorted((r.case_id, r.n) for r in spark.read.parquet(target).collect())

    lost = str(tmp_path / "lost")
    assert run("one", [("a", 1), ("b", 2), ("b", 1)], checkpoint=lost) == [("a", 1), ("b", 1)]
    # another folder with a state of its own, beside the results
    assert run("two", [("b", 3), ("c", 3)]) == [("a", 1), ("b", 1), ("c", 3)]
    # the first state is lost: all its files arrive again
    assert run("one", [("d", 4)], checkpoint=str(tmp_path / "new")) == [("a", 1), ("b", 1), ("c", 3), ("d", 4)]
    # the last batch is replayed
    commits = tmp_path / "new" / "commits"
    for name in ("0", ".0.crc"):
        (commits / name).unlink(missing_ok=True)
    incremental.run_available(spark, str(tmp_path / "one"), schema, target, checkpoint=str(tmp_path / "new"))
    assert sorted((r.case_id, r.n) for r in spark.read.parquet(target).collect()) == [("a", 1), ("b", 1), ("c", 3), ("d", 4)]
