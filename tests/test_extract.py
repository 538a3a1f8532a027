"""Field extraction, checked against the plain patterns and hand-written results."""

import re

import pytest

from caselode import profile as P
from caselode.functions import extract as X

CH = r"[A-Za-z0-9\s\.,\-/]"


def plain_names(text, party):
    """All names by the unrewritten patterns."""
    found = []
    for pattern in (
        rf"([A-Z]{CH}+?)\s*,?\s*selanjutnya\s+disebut\s+(?:sebagai\s+)?{party}",
        rf"([A-Z]{CH}+?)\s*(?:dalam hal ini diwakili\s+oleh\s+.+?)?\s*sebagai\s+{party}",
        rf"{party}\s*(?:adalah|:)?\s*([A-Z]{CH}{{3,60}})",
    ):
        found += [m.strip() for m in re.findall(pattern, text, re.I) if len(m.strip()) > 3]
    return list(dict.fromkeys(found))[:5]


TEXTS = [
    "budi santoso, selanjutnya disebut sebagai penggugat; melawan : pt maju jaya, selanjutnya disebut tergugat;",
    "antara : ani sebagai penggugat dan beni sebagai penggugat (cici) dodi sebagai tergugat",
    "pt a dalam hal ini diwakili oleh (direktur x) sebagai penggugat dan pt b sebagai penggugat; selesai",
    "pt a dalam hal ini diwakili oleh tn. x; y sebagai tergugat\ncv z sebagai tergugat lalu penggugat : eko prasetyo",
    "1. aaaa sebagai penggugat 2. bbbb sebagai penggugat 3. cccc sebagai penggugat; dddd sebagai penggugat; "
    "eeee sebagai penggugat; ffff sebagai penggugat",
    "selanjutnya disebut penggugat; sebagai penggugat",
    "abc sebagai penggugat; abcd sebagai penggugat",
    "tergugat adalah pt sumber makmur; tergugat: cv untung",
    "\n\npak eko,\nselanjutnya   disebut\npenggugat.",
]


@pytest.mark.parametrize("party,alias", [("penggugat", "pemohon"), ("tergugat", "termohon")])
def test_party_names_equal_the_plain_patterns(one, party, alias):
    got = one(lambda t: X.party_names(t, party, alias), TEXTS)
    for text, names in zip(TEXTS, got):
        expected = plain_names(text, party)
        if not expected:
            m = re.search(rf"(?:{party}|{alias})\s*[:\-]?\s*([A-Z][A-Za-z\s\.]{{3,50}})", text, re.I)
            expected = [m.group(1).strip()] if m else []
        assert names == expected, text


def test_long_runs_take_linear_time(one):
    run = "kata demi kata " * 40_000  # one run of 600,000 name characters without an anchor
    text = run + "; anita sebagai penggugat; " + run
    assert one(lambda t: X.party_names(t, "penggugat", "pemohon"), [text]) == [["anita"]]


def test_party_estimate_and_absence(one):
    texts = ["tidak ada pihak", "anita sebagai penggugat " + "; (penggugat) " * 11, "pemohon : siti aminah;"]
    got = one(lambda t: X.parties(t, "penggugat", "pemohon"), texts)
    assert [(r.names, r.n) for r in got] == [
        (P.NOT_DETECTED, 0), ("anita", 4), ("siti aminah", 1),
    ]


def test_statutes(one):
    texts = [
        "pasal 1365 kuhperdata dan pasal  1365 kuhperdata serta pasal 5 ayat (1) uu 1999",
        "pasal 1, 2 kuhp",
        "; ".join(f"pasal {i} kuhp" for i in range(1, 13)),
        "tanpa rujukan",
    ]
    got = one(X.statutes, texts)
    assert got[0] == "pasal 1365 kuhperdata, pasal 5 ayat (1) uu 1999, pasal 5 ayat"
    assert got[1] == "pasal 1, 2 kuhp" and got[3] == ""
    assert got[2].split(", ") == [f"pasal {i} kuhp" for i in range(1, 11)]
    assert one(lambda t: X.listed(X.statutes(t)), texts) == [3, 2, 10, 0]


def test_facts_by_priority(one):
    body30, body31 = " ".join(["fakta"] * 30), " ".join(["fakta"] * 31)
    long_lines = "\n".join(f"{i} " + "x" * 60 for i in range(9))
    texts = [
        f"duduk perkara\n{body31}\n\nlain",
        f"duduk perkara\n{body30}\n\nmenimbang: hal satu; mengadili",
        "menimbang mengadili dan seterusnya",
        long_lines,
        "pendek saja",
        "a" * 40 + "\n" + "b" * 60,
        f"duduk perkara\n{'kata ' * 400}",
    ]
    got = one(X.facts, texts)
    assert got[0] == body31 and got[1] == "hal satu;" and got[2] == ""
    assert got[3] == " ".join(long_lines.split("\n")[2:7])
    assert got[4] == "pendek saja" and got[5] == "" and len(got[6]) == 800


def test_arguments(one):
    body = " ".join(["hukum"] * 21)
    texts = [
        f"pertimbangan hukum\n{body}\n",
        "menimbang, bahwa satu; menimbang bahwa dua menimbang, bahwa tiga mengadili menimbang bahwa empat;",
        "tanpa",
    ]
    assert one(X.arguments, texts) == [body, "satu | dua | tiga", ""]


def test_decision_rules(spark):
    cases = [
        (None, "gugatan gugur", "gugur"), ("", "tanpa", "lainnya"),
        ("Dikabulkan untuk SELURUHNYA", "ditolak", "dikabulkan_seluruhnya"),
        ("dikabulkan sebagian", "", "dikabulkan_sebagian"),
        ("gugatan tidak dapat diterima", "", "ditolak"),
        ("lain-lain", "permohonan dikabulkan", "dikabulkan"),
    ]
    rows = spark.createDataFrame([(a, t) for a, t, _ in cases], "a string, t string").coalesce(1)
    got = rows.select(X.decision(rows.a, rows.t).alias("d")).collect()
    assert [r.d for r in got] == [d for *_, d in cases]


def test_merged_labels(one):
    labels = ["dikabulkan_sebagian", " Ditolak ", "niet_ontvankelijke_verklaard", "gugur", None]
    assert one(X.merged_label, labels) == ["dikabulkan", "ditolak", "ditolak", "lainnya", "lainnya"]
