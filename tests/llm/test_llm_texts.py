"""Operators that judge or change one text at a time, against plain Python."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from caselode.llm import decontaminate as decon
from caselode.llm import license_scan, pii, quality_rules, words

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_words_and_windows_stay_in_their_text():
    data, borders = words.text_bytes(pa.array(["a b", None, "", "b c d\x0be", " x "]))
    found = words.Words(data, borders, words.space_words())
    assert found.count.tolist() == [2, 0, 0, 4, 1]
    keys, at = words.windows(found.hashes(), found.first, 2)
    assert at.tolist() == [0, 2, 3, 4] and len(set(keys.tolist())) == 4
    wide, at = words.windows(found.hashes(), found.first, 13)
    assert len(wide) == len(at) == 0


def test_equal_words_have_equal_hashes_wherever_they_are():
    data, borders = words.text_bytes(pa.array(["ab cd", "xx ab", "cd", "a bcd"]))
    h = words.Words(data, borders, words.space_words()).hashes()
    assert h[0] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 5


def thue_morse(n):
    """Two words of a and b that agree under every polynomial hash modulo 2**64, if n is 1,024 or more."""
    one = "".join("ab"[i.bit_count() & 1] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_hashes_of_words_without_a_pattern_in_common():
    texts = [x for n in (64, 1024, 2048, 4096) for x in thue_morse(n)]
    texts += ["a" * n for n in range(1, 40)] + ["a" * n + "b" + "a" * (30 - n) for n in range(31)]
    texts += [f"{'x' * 8}{'y' * 8}", f"{'y' * 8}{'x' * 8}", "x" * 8 + "a" * 8 + "x" * 8, "a\0", "a\0\0", "\0a"]
    data, borders = words.text_bytes(pa.array([f" {t} " for t in texts]))
    h = words.Words(data, borders, words.space_words()).hashes()
    assert len(h) == len(texts) and len(set(h.tolist())) == len(set(texts))


def test_pieces_keep_long_texts_whole():
    texts = ["x" * 3_000_000, "a", "", "b" * 10]
    got = [(a, b, len(d)) for a, b, d, _ in words.pieces(pa.array(texts))]
    assert got == [(0, 1, 3_000_000), (1, 4, 11)]


# quality rules


def plain_counts(text):
    ws = SPACE_WORD.findall(text or "")
    grams = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    often = collections.Counter(grams)
    hit = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if SPACE_WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(hit)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@pytest.mark.parametrize("source", ["tables", "edges"])
def test_rule_counts_equal_plain_counts(spark, folder, edge_docs, source):
    docs = documents(spark, folder) if source == "tables" else edge_docs
    texts = collections.Counter((r.doc_id, plain_counts(r.text)) for r in docs.collect())
    judged = quality_rules.quality_rules(docs).collect()
    assert collections.Counter((r.doc_id, tuple(r[c] for c in BASE)) for r in judged) == texts
    for r in judged:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and r.posterior >= 0.5)


def test_random_texts_count_alike():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab \n\t|é#") for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    data, borders = words.text_bytes(pa.array(texts))
    got = quality_rules.counts(data, borders)
    assert [tuple(int(got[c][i]) for c in BASE) for i in range(len(texts))] == list(map(plain_counts, texts))


def test_rules_tell_patterned_words_apart():
    one, other = thue_morse(1024)
    texts = [" ".join([one] * 5 + [other] * 5) + f"\n{one} x\n{other} x", f"{one}\n{other}\n{one}"]
    got = quality_rules.counts(*words.text_bytes(pa.array(texts)))
    assert [tuple(int(got[c][i]) for c in BASE) for i in range(2)] == list(map(plain_counts, texts))


def test_estimation_finds_the_accuracies_of_made_up_rules():
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.5
    votes = np.full((20_000, 5), quality_rules.ABSTAIN)
    for j, accuracy in enumerate([0.95, 0.9, 0.8, 0.75, 0.6]):
        said = np.where(rng.random(20_000) < accuracy, truth, ~truth)
        cast = rng.random(20_000) < 0.8
        votes[cast, j] = np.where(said, quality_rules.GOOD, quality_rules.BAD)[cast]
    patterns, weight = np.unique(votes, axis=0, return_counts=True)
    posterior, accuracy = quality_rules.estimate(patterns, weight)
    assert np.abs(accuracy - [0.95, 0.9, 0.8, 0.75, 0.6]).max() < 0.03
    assert (np.diff(accuracy) < 0).all() and 0 <= posterior.min() <= posterior.max() <= 1


def test_rules_agree_with_the_labels(spark, folder):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [(labels[r.doc_id], r.kept) for r in quality_rules.quality_rules(documents(spark, folder)).collect() if r.doc_id in labels]
    assert sum(kept for good, kept in judged if good) >= 0.9 * sum(good for good, _ in judged)
    assert sum(kept for good, kept in judged if not good) <= 0.2 * sum(not good for good, _ in judged)


def test_rules_on_an_empty_table(no_docs):
    assert quality_rules.quality_rules(no_docs).count() == 0


# decontamination


def plain_hits(texts, items):
    windows = collections.defaultdict(set)
    for i, t in items:
        ws = LETTER_WORD.findall(lower(t))
        k = min(13, len(ws))
        for j in range(len(ws) - k + 1 if k else 0):
            windows[tuple(ws[j : j + k])].add(str(i))
    for i, t in texts:
        ws = LETTER_WORD.findall(lower(t))
        hit, of = set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(ws) - k + 1):
                if found := windows.get(tuple(ws[j : j + k])):
                    hit.update(range(j, j + k))
                    of |= found
        yield i, len(ws), len(hit), tuple(sorted(of)), bool(hit) and 20 * len(hit) >= len(ws)


ITEMS = [(1, "one two three"), (2, None), (3, ""), (4, "B c, D! e f g h i j k l m n o p"), (5, "one two three"), (4, "word")]


@pytest.mark.parametrize("source", ["tables", "edges"])
@pytest.mark.parametrize("block", [None, 20])
def test_hits_equal_plain_hits(spark, folder, edge_docs, monkeypatch, source, block):
    if block:  # several blocks of the benchmark
        monkeypatch.setattr(decon, "BLOCK_BYTES", block if source == "edges" else 4000)
    if source == "tables":
        docs, bench = documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet")
    else:
        docs, bench = edge_docs, spark.createDataFrame(ITEMS, "item_id long, text string")
    rows, items = docs.collect(), bench.collect()
    want = collections.Counter(plain_hits([(r.doc_id, r.text) for r in rows], [(r.item_id, r.text) for r in items]))
    got = decon.scan_benchmark(docs, bench).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got) == want
    if source == "edges":
        assert sum(r.n_hit for r in got) > 0
    clean = decon.decontaminate(docs, bench).collect()
    assert collections.Counter(clean) == collections.Counter(
        r for r, w in zip(rows, plain_hits([(r.doc_id, r.text) for r in rows], [(r.item_id, r.text) for r in items])) if not w[4]
    )


def test_spans_are_cut_and_nothing_else(spark):
    docs = spark.createDataFrame([(1, "Say: ONE, two; three! end"), (2, None), (3, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    got = {r.doc_id: r.text for r in decon.decontaminate(docs, bench, remove="spans").collect()}
    assert got == {1: "Say: ! end", 2: None, 3: "clean"}
    with pytest.raises(ValueError):
        decon.decontaminate(docs, bench, remove="words")


def test_spans_are_cut_alike_in_one_and_many_blocks(spark, monkeypatch):
    said = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40)]
    items = [(k, " ".join(said[a:b])) for k, (a, b) in enumerate([(1, 20), (10, 30), (0, 13), (17, 33)])] + [(9, "left right")]
    texts = ["Say: " + ", ".join(said) + "! end", "left " + " ".join(said[1:30]) + " right", None, "clean", "left right x left right"]
    docs = spark.createDataFrame([(k % 4, t, k) for k, t in enumerate(texts * 2)], "doc_id long, text string, k int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    cut = lambda: sorted(map(tuple, decon.decontaminate(docs, bench, remove="spans").collect()), key=lambda r: r[2])
    one = cut()
    assert [t for _, t, _ in one[:5]] == ["Say: , " + ", ".join(said[33:]) + "! end", "left  right", None, "clean", " x "]
    monkeypatch.setattr(decon, "BLOCK_BYTES", 60)
    assert len(list(decon._blocks(bench, "item_id", "text"))) > 3
    assert cut() == one


def test_blocks_of_a_benchmark_are_scanned_one_by_one(spark, monkeypatch):
    """Twenty blocks and more: one is in the driver at a time, one scan is in a plan, hits are merged once."""
    rng = random.Random(3)
    said = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(said[i * 7 : i * 7 + rng.randint(5, 30)])) for i in range(50)]
    texts = [(i % 7 if i % 5 else None, " ".join(said[a : a + 60]) + " x" * (i % 3)) for i in range(60) for a in [rng.randint(0, 390)]]
    texts += [(None, None), (None, ""), (1, "clean"), texts[0], texts[0]]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = collections.Counter(plain_hits(texts, items))
    runs = lambda: [(r.doc_id, r.n_words, r.hit_from, r.hit_to, r["items"]) for r in decon.scan_benchmark(docs, bench).collect()]
    key = lambda r: str(r)
    one = sorted(runs(), key=key)
    monkeypatch.setattr(decon, "BLOCK_BYTES", 200)
    assert decon._n_blocks(bench, "text") >= 20
    got = decon.scan_benchmark(docs, bench)
    assert collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got.collect()) == want
    assert sorted(runs(), key=key) == one
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 6 and plan.count("Join") <= 4


def test_empty_tables_are_clean(edge_docs, no_docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decon.scan_benchmark(edge_docs, none).filter("n_hit > 0 or contaminated").count() == 0
    assert decon.scan_benchmark(no_docs, spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_digest_of_items():
    assert decon.items_digest(["10", "9"]) == hashlib.sha256(b"10,9").hexdigest()


# personal data

PATTERNS = [
    re.compile(x)
    for x in (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    )
]


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == 1:
        return all(int(p) <= 255 for p in text.split("."))
    if kind == 2:
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def plain_spans(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in p.finditer(text) if valid(k, m[0]))


def test_base_spans_equal_the_patterns(spark, folder):
    rng = random.Random(7)
    parts = ["1", "12", "255", "4539148803436467", "+", "+1", "(", ")", " ", "-", ".", "@", "a", "b.c", "x@y.z", "é", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    texts += [r.text for r in documents(spark, folder).collect()]
    for text in texts:
        assert pii.base_spans(text) == plain_spans(text), text


def test_likelihood_gradient_is_the_slope():
    rng = np.random.default_rng(1)
    text = "x 10.0.0.1, 4539148803436467, +1 (988) 555-2485, a.b@c.org 12 y"
    (tokens,) = pii.zones(text)
    found = pii.candidates(text, tokens)
    number = {(i, j, k): n for n, (i, j, k, _) in enumerate(found)}
    gold = [number[key] for key in pii._in_zone(tokens, pii.base_spans(text))]
    assert len(gold) == 4
    field = pii.Field(rng.normal(size=len(pii.FEATURES)))
    log, grad = field.gradient(len(tokens), found, gold)
    for f in range(len(grad)):
        step = np.zeros(len(grad))
        step[f] = 1e-5
        up, _ = pii.Field(field.weights + step).gradient(len(tokens), found, gold)
        down, _ = pii.Field(field.weights - step).gradient(len(tokens), found, gold)
        assert abs((up - down) / 2e-5 - grad[f]) < 1e-4


def test_best_segmentation_equals_trying_all():
    rng = np.random.default_rng(2)
    for _ in range(200):
        found = []
        for _ in range(rng.integers(1, 9)):
            i = int(rng.integers(0, 6))
            found.append((i, int(rng.integers(i + 1, 8)), 0, [(int(rng.integers(0, 9)), float(rng.normal() * 5))]))
        field = pii.Field(np.append(rng.normal(size=len(pii.FEATURES) - 1) * 2, -0.5))

        def value(chosen):
            spans = sorted((found[k][0], found[k][1]) for k in chosen)
            if any(a[1] > b[0] for a, b in zip(spans, spans[1:])):
                return -np.inf
            if any(field.score(found[k][3]) <= pii.LEAST_GAIN for k in chosen):
                return -np.inf
            return sum(field.score(found[k][3]) for k in chosen) - 0.5 * sum(a[1] == b[0] for a, b in zip(spans, spans[1:]))

        every = [[k for k in range(len(found)) if m >> k & 1] for m in range(1 << len(found))]
        assert abs(value(field.segment(7, found)) - max(map(value, every))) < 1e-9


def test_field_adds_what_the_patterns_drop(spark, folder):
    docs = spark.read.parquet(f"{folder}/../sf0.01/documents.parquet")
    field = pii.trained_field(docs)
    added = lambda t: [(pii.KINDS[k], t[a:b]) for a, k, b in pii.all_spans(t, field)[1]]
    assert added("ask +1 (826) 555-4081 190.137.223.204 now") == [("phone", "+1 (826) 555-4081")]
    assert added("pay 4539148803436467 7 times") == [("card", "4539148803436467")]
    assert added("Version 2.0 of 2024-01-02, 12 345 678") == []
    clean = [r.text for r in docs.filter("not text rlike '[0-9@]'").limit(200).collect()]
    assert not any(any(pii.all_spans(t, field)) for t in clean)


def test_rare_spans_train_the_field(spark, monkeypatch):
    plain = [(i, f"in {1900 + i % 100} there were {i % 9} of {i} and 12 345 678") for i in range(3000)]
    rare = [(5000 + i, f"write to a{i}.b@c.example.org or call +1 (988) 555-2{400 + i}, card 4539148803436467 ip 10.0.0.{i}") for i in range(3)]
    monkeypatch.setattr(pii, "SPANLESS_DOCS", 20)
    schema = "doc_id long, text string"
    field = pii.trained_field(spark.createDataFrame(plain + rare, schema).repartition(3))
    assert field is not None and not np.array_equal(field.weights, pii.Field.prior)
    added = lambda t: [(pii.KINDS[k], t[a:b]) for a, k, b in pii.all_spans(t, field)[1]]
    assert added("pay 4539148803436467 7 times") == [("card", "4539148803436467")]
    # digits but no span anywhere: the weights before training; whatever the size of one text, little is sent
    spanless = pii.trained_field(spark.createDataFrame(plain, schema))
    assert np.array_equal(spanless.weights, pii.Field.prior)
    long = pii.examples("1 2 3 4 5 " * 30_000 + " ".join(f"word word word word word {i}00000000" for i in range(200)))
    assert len(long) <= 2 * pii.TRAIN_ZONES and max(n for n, _, _ in long) <= pii.ZONE_TOKENS


def test_pii_on_edges_and_empty_tables(edge_docs, no_docs):
    field = pii.trained_field(edge_docs)
    got = collections.Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.base)) for r in pii.find_pii(edge_docs, field).collect())
    want = collections.Counter(
        (r.doc_id, tuple((pii.KINDS[k], a, b) for a, k, b in pii.base_spans(r.text or ""))) for r in edge_docs.collect()
    )
    assert got == want
    assert pii.trained_field(no_docs) is None and pii.find_pii(no_docs, None).count() == 0


# licenses


def test_notices_are_told_apart():
    scanner = license_scan.Scanner()
    for name, text in (
        ("Apache-2.0", b"Licensed under the Apache License, Version 2.0."), ("MIT", b"Released under the MIT License."),
        ("GPL-3.0", b"This work is licensed under the GNU General Public License, version 3."),
        ("GPL-2.0", b"This work is licensed under the GNU General Public License, version 2."),
        ("CC-BY-NC-4.0", b"Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", b"Licensed under CC BY 4.0."),
    ):
        assert scanner.winner(text)[0] == name
        assert scanner.winner(text)[2] == []
    for text in (b"He lost his driving license in 2020.", b"Licensed under the Apache License, Version 1.1.", b"Licensed under CC BY-ND 3.0."):
        assert scanner.winner(text) is None


def test_every_template_wins_its_own_sentences():
    scanner = license_scan.Scanner()
    for name, text in license_scan.TEMPLATES.items():
        assert scanner.winner(text.encode())[0] == name


WRAPPED = {
    "GPL-2.0": """# This program is free software; you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation; either version 2 of the License, or
# (at your option) any later version.""",
    "LGPL-2.1": """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.""",
    "AGPL-3.0": """// This program is free software: you can redistribute it and/or modify
// it under the terms of the GNU Affero General Public License as published by
// the Free Software Foundation, either version 3 of the License, or
// (at your option) any later version.""",
    "BSD-2-Clause|BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
}


@pytest.mark.parametrize("name", WRAPPED)
@pytest.mark.parametrize("before", ["", "int main;\n\n", "A heading\n", "Some words of prose.\n"])
def test_wrapped_notices_are_read_as_a_whole(name, before):
    _, rows = license_scan.Scanner().found((before + WRAPPED[name]).encode())
    assert {r[0] for r in rows} == {name}


BSD = """Copyright (c) 2020, Some One

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{clause}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


@pytest.mark.parametrize("name, clause", [("BSD-2-Clause", ""), ("BSD-3-Clause", THIRD)])
def test_paragraphs_of_one_notice_give_one_verdict(name, clause):
    _, rows = license_scan.Scanner().found(BSD.format(clause=clause).encode())
    assert [r[0] for r in rows] == [name]


EVERYDAY = {
    "License: MIT": ["MIT"], "This code is under GPLv3.": ["GPL-3.0"], "GPLv2 or later": ["GPL-2.0"],
    "GNU GENERAL PUBLIC LICENSE\n    Version 3, 29 June 2007": ["GPL-3.0"],
    "GNU GENERAL PUBLIC LICENSE\n    Version 2, June 1991": ["GPL-2.0"],
    "// SPDX-License-Identifier: Apache-2.0 OR MIT\nint x;": ["Apache-2.0", "MIT"],
    "# SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) AND MIT": ["GPL-2.0", "MIT"],
    "SPDX-License-Identifier: MPL-2.0": ["MPL-2.0"],
    "This file is licensed under the Apache License 2.0": ["Apache-2.0"],
    "This project is licensed under the MIT License - see the LICENSE file for details": ["MIT"],
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.":
        ["CC-BY-NC-SA-4.0"],
    "Licensed under CC BY-NC-ND 4.0.": ["CC-BY-NC-ND-4.0"],
    "The license fee is due in May.": [], "See the license for details.": [], "All rights reserved, no license.": [],
    "He went to MIT on a license to study.": [], "SPDX-License-Identifier: Unknown-1.0": [], "license: proprietary": [],
}


@pytest.mark.parametrize("text", EVERYDAY)
def test_everyday_notices(text):
    assert [r[0] for r in license_scan.Scanner().found(text.encode())[1]] == EVERYDAY[text]


def plain_ranks(notice):
    """(bytes saved, license) by plain Zstandard frames, most first."""
    import zstandard as z

    plain = lambda **more: z.ZstdCompressor(compression_params=z.ZstdCompressionParameters.from_level(
        3, format=z.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0), **more)
    size = len(plain().compress(notice.lower()))
    out = []
    for name, text in license_scan.TEMPLATES.items():
        given = z.ZstdCompressionDict(text.lower().encode(), dict_type=z.DICT_TYPE_RAWCONTENT)
        out.append((size - len(plain(dict_data=given).compress(notice.lower())), name))
    return size, sorted(out, reverse=True)


def test_the_winner_saves_most_of_those_that_the_wording_confirms():
    scanner = license_scan.Scanner()
    notices = [t.encode() for t in license_scan.TEMPLATES.values()]
    notices += [s.strip().encode() + b"." for t in license_scan.TEMPLATES.values() for s in t.split(". ")]
    notices += [license_scan.unwrapped(t.encode()) for t in (*WRAPPED.values(), *EVERYDAY)]
    n_won = 0
    for notice in notices:
        won = scanner.winner(notice)
        size, ranks = plain_ranks(license_scan.unwrapped(notice))
        borne_out = []
        for saved, name in ranks:
            known = license_scan.words_of(license_scan.TEMPLATES[name])
            own = license_scan.words_of(notice.decode())
            if saved >= license_scan.LEAST_SAVED * size and not (set(own) - set(known)) & license_scan.TELLING:
                borne_out.append(name)
        if won:
            n_won += 1
            names = won[0].split("|")
            assert set(names) <= set(borne_out)
            saved = {name: s for s, name in ranks}
            most = max(saved[n] for n in borne_out if scanner.differences(notice.decode(), scanner.names.index(n))[0] >= 0.8
                       and not license_scan.TELLING.intersection(scanner.differences(notice.decode(), scanner.names.index(n))[1]))
            assert all(saved[n] >= most - license_scan.EQUAL_SAVED for n in names)
    assert n_won > len(license_scan.TEMPLATES)


def test_shared_wording_names_no_single_license():
    scanner = license_scan.Scanner()
    assert scanner.winner(b"it under the terms of the GNU General Public License as published by")[0] == "GPL-3.0|GPL-2.0"
    other = WRAPPED["LGPL-2.1"].replace("2.1", "2.4").encode()
    assert scanner.found(other)[1] == []


def test_license_rows(edge_docs, no_docs, spark, folder):
    rows = {r.doc_id: r for r in license_scan.license_scan(edge_docs).collect()}
    assert [x.license for x in rows[17].found] == ["Apache-2.0", "MIT"]
    text = dict(r[:2] for r in edge_docs.select("doc_id", "text").collect())[17]
    assert [text[x.start : x.end] for x in rows[17].found] == text.split("\n")
    assert all(not r.found for i, r in rows.items() if i != 17)
    assert license_scan.license_scan(edge_docs).count() == edge_docs.count()
    assert license_scan.license_scan(no_docs).count() == 0
    docs = documents(spark, folder)
    found = {r.doc_id: len(r.found) for r in license_scan.license_scan(docs).collect()}
    notice = re.compile(r"(Licensed under the Apache License, Version 2\.0\.|Released under the MIT License\.|GNU General Public License, version 3\.|Licensed under CC BY-NC 4\.0\.)")
    assert found == {r.doc_id: len(notice.findall(r.text)) for r in docs.collect()}
