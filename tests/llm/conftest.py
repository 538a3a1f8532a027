import os

import pytest

FOLDER = "/root/testdata/sf0.001"

#: Nulls, empty and blank texts, other scripts, repeated rows, ties, one very long text.
EDGE_TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "one two three"), (6, "One two THREE"),
    (7, "a b c d e f g h i j k l m n o p q r s t u v w x y z"), (8, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (8, "a b c d e f g h i j k l m n o p q r s t u v w x y z"), (9, "日本語 のテキスト é à ü   x"),
    (10, "l1 x\nl2 x\nl3 x\nl4 x\nl1 x\nl2 x\nl3 x\n"), (11, "l2 x\nl3 x\nl4 x"), (None, "no id here at all"),
    (12, "mail a.b@c.example.org call +1 (988) 555-2485, card 4539148803436467, ip 10.0.0.1"),
    (13, "long " * 120_000 + "\n" + "x" * 200_000), (14, "1" * 200_000), (15, "@" * 50_000), (16, "a" * 100_000 + "@"),
    (17, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."),
]


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip("test tables are not here")
    return FOLDER


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Edge texts with metadata that has nulls, and columns whose names operators use inside."""
    rows = [
        (i, t, None if k % 4 == 0 else "en", None if k % 3 == 0 else f"s{k % 5}", None if k % 5 == 0 else k,
         k, k, "x", None, k, k, "y")
        for k, (i, t) in enumerate(EDGE_TEXTS)
    ]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, "
        "id int, size long, key string, c string, n int, target long, `_text` string",
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
