"""Text expressions on hand-written edge cases."""

import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from caselode.functions import text as T
from caselode.operators import corpus


def test_words_and_strip_know_every_white_space(one):
    texts = ["", "  \t\n", "a", " a b ", "a\x1cb\x1fc", "a b c", "\x85a\x85", "a\r\nb\x0bc"]
    assert one(T.words, texts) == [len(t.split()) for t in texts]
    assert one(T.strip, texts) == [t.strip() for t in texts]


def test_cleaning_keeps_the_order_of_rules(one):
    texts = [
        "Direktori Putusan Republik Indonesia\nisi",
        "Republik Indonesia\nREPUBLIK  INDONESIA\nisi",
        "Mahkamah Agung Republik Indonesia\nisi",
        "direktori putusan mahkamah\nisi",
        "putusan . . go . id apa saja\nisi",
        "M a h k a m a h A g u n g\nisi",
        "M a h ka m a h A g u n g R e p u blik In d o n esia isi",
        "Halaman 3 dari 12 halaman isi Halaman 4",
        "12 hal. put. nomor 3/Pdt\nisi",
        "DISCLAIMER isi disclaimer",
        "a  \t b\n\n\n\nc",
    ]
    assert one(T.clean, texts) == [
        "isi", "isi", "Mahkamah Agung Republik Indonesia\nisi", "isi", "isi", "isi", "isi",
        "isi", "isi", "isi", "a b\n\nc",
    ]


def test_thousands_of_repeats_do_not_overflow_the_matcher(one):
    headline = "Republik Indonesia\n" * 20_000
    assert one(T.clean, [headline + "isi"]) == ["isi"]
    assert one(T.content_words, [headline + "isi sini"]) == [2]
    chain = "-".join(["a"] * 30_000)
    assert one(T.tokens, [chain]) == [[chain]]


def test_normalising(one):
    texts = ["A..,,;;::B", "a\n \n \nb", "a\tb\x0cc", "É × ÷ ü 中 x", "  X  \n", "a\n\n\n\nb", "(A) \"B\" 5%"]
    assert one(T.normalise, texts) == [
        "a.,;:b", "a\n\n\nb", "a b c", "é × ÷ ü x", "x", "a\n\nb", '(a) "b" 5%',
    ]


def test_tokens_split_on_accents(one):
    assert one(T.tokens, ["Ganti-rugi d'Or é1 caf\xe9s -x- a--b", ""]) == [
        ["ganti-rugi", "d'or", "1", "caf", "s", "x", "a", "b"], [],
    ]


def test_content_words_skip_boilerplate_lines(one):
    texts = [
        "satu dua\fRepublik Indonesia tiga",
        "Direktori satu\nKepaniteraan dua\nputusan.go.id\nDisclaimer\ninakurasi x\nisi",
        "  republik   indonesia republik indonesia \nisi",
        "republik indonesia raya\n",
        "",
    ]
    assert one(T.content_words, texts) == [3, 1, 1, 3, 0]


def _text(n, word="kata"):
    return " ".join([word] * n)


def test_measured_limits(spark):
    raw = {
        "empty": "", "blank": " \n ", "w49": _text(49), "w50": _text(50), "w99": _text(99),
        "w100": _text(100),
        # 200 content words; a pattern removes the one line that holds half of them
        "half": _text(100) + "\nputusan . go . id " + _text(95),
        "less": _text(100) + "\nputusan . go . id " + _text(97),
    }
    rows = spark.createDataFrame(list(raw.items()), "id string, raw_text string")
    got = {r.id: r for r in corpus.normalised(corpus.measured(rows)).collect()}
    assert {k: r.status for k, r in got.items()} == {
        "empty": "no_text", "blank": "scan_skip", "w49": "scan_skip", "w50": "text", "w99": "text",
        "w100": "text", "half": "text", "less": "text",
    }
    assert [got[k].jumlah_kata for k in ("w49", "w50", "w100")] == [0, 50, 100]
    assert [got[k].valid_min_200_kata for k in ("w50", "w99", "w100", "half", "less")] == [
        False, False, True, True, False,
    ]
    assert got["half"].keutuhan_teks == 0.5 and got["empty"].keutuhan_teks == 0.0
    assert got["w100"].jumlah_token == 100


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aB1.,;:é \t\n\x0c\x85-'", max_size=40), min_size=20, max_size=40))
def test_normal_form_has_no_runs(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    for r in rows.select("t", T.normalise(F.col("t")).alias("x"), T.words(F.col("t")).alias("w")).collect():
        assert r.w == len(r.t.split())
        assert not re.search(r"  |([.,;:])\1| \n|\n |^\s|\s$|[A-Z\t]", r.x)
