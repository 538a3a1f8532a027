"""Quality rules by weak supervision.

Every rule votes on a document (good, bad or abstain). How often each rule's votes are right is
estimated by expectation-maximisation over all documents, without labels, and a document is judged
by the posterior probability that it is good instead of having to pass every rule.

The estimation needs only the number of documents with each pattern of votes: at most
3 ** len(RULES) rows, whatever the size of the corpus.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselode.session import staged

from . import words as w
from .common import id_and_text, map_batches

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
GOOD, BAD, ABSTAIN = 2, 0, 1

#: name: (a share, bad from here on, good up to here); between the two the rule abstains.
#: A limit of None never holds. Most rules speak up only against a document.
RULES = {
    "odd_words": (("n_odd_words", "n_words"), 0.35, 0.10),
    "symbols_per_word": (("n_symbols", "n_words"), 0.20, None),
    "repeated_windows": (("n_repeat_words", "n_words"), 0.30, None),
    "repeated_lines": (("n_dup_lines", "n_lines"), 0.50, None),
    "upper_case": (("n_upper", "n_letters"), 0.50, None),
    "exclamations": (("n_exclaim", "n_words"), 0.30, None),
    "word_again": (("n_same_as_last", "n_words"), 0.20, None),
    "word_length": (("word_chars", "n_words"), 15.0, None),
    "control_bytes": (("n_control", "word_chars"), 0.02, None),
}
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_upper", "n_letters", "n_exclaim", "n_same_as_last", "n_control", "n_odd_words",
)


def _byte_table(values):
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


_SYMBOL = _byte_table(SYMBOLS)
_UPPER = _byte_table(range(0x41, 0x5B))
_LETTER = _byte_table([*range(0x41, 0x5B), *range(0x61, 0x7B)])
_CONTROL = _byte_table([*range(9), *range(0x0E, 0x20), 0x7F])
_ENDS_WORD = _byte_table(b".,;:!?")
_PLAIN = _byte_table([*range(0x30, 0x3A), *b"'-", *range(0x80, 0x100)]) | _LETTER
_STARTS_CHAR = ~_byte_table(range(0x80, 0xC0))
_SPACE_WORDS = w.space_words()


def counts(data, borders) -> dict[str, np.ndarray]:
    """The counts that the rules use, for each of some texts given as bytes and borders."""
    words = w.Words(data, borders, _SPACE_WORDS)
    by_byte = lambda mask: w.per_text(mask, borders)
    n = len(borders) - 1
    hashes = words.hashes()
    at_window, first_word = w.windows(hashes, words.first, WINDOW)
    text = words.text_of_word()
    twice, _ = w.repeated(at_window, text[first_word])
    repeat = w.covered(len(hashes), first_word[twice], WINDOW)
    start, end, line_text = words.lines()
    _, later = w.repeated(words.span_hashes(start, end), line_text)
    odd = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~_PLAIN[data], out=odd[1:])
    # a word is plain with letters, digits, ' and -, and at most one mark at its end
    n_odd = odd[words.end] - odd[words.start] - _ENDS_WORD[data[words.end - 1]]
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    return {
        "n_words": words.count,
        "word_chars": by_byte(_SPACE_WORDS[data] & _STARTS_CHAR[data]),
        "n_symbols": by_byte(_SYMBOL[data]),
        "n_dup_lines": np.bincount(line_text[later], minlength=n),
        "n_repeat_words": w.per_text(repeat, words.first),
        "n_lines": np.bincount(line_text, minlength=n),
        "n_upper": by_byte(_UPPER[data]),
        "n_letters": by_byte(_LETTER[data]),
        "n_exclaim": by_byte(data == 0x21),
        "n_same_as_last": w.per_text(again, words.first),
        "n_control": by_byte(_CONTROL[data]),
        "n_odd_words": w.per_text((n_odd > 0) | (words.end - words.start == 1) & ~_PLAIN[data[words.start]], words.first),
    }


def votes(count: dict[str, np.ndarray]) -> np.ndarray:
    """Every rule's vote (BAD, ABSTAIN, GOOD) on every document, rules in columns.

    A share without a base (a text without words, letters or lines) is no ground for a vote.
    """
    out = []
    for (above, below), bad, good in RULES.values():
        base = count[below]
        share = count[above] / np.maximum(base, 1)
        vote = np.full(len(base), ABSTAIN)
        if good is not None:
            vote[share <= good] = GOOD
        vote[share >= bad] = BAD
        vote[base == 0] = ABSTAIN
        out.append(vote)
    return np.stack(out, 1)


def pattern_code(vote: np.ndarray) -> np.ndarray:
    return vote @ 3 ** np.arange(vote.shape[1])


def pattern_votes(code, n_rules=len(RULES)) -> np.ndarray:
    return np.asarray(code)[:, None] // 3 ** np.arange(n_rules) % 3


def estimate(vote, weight, rounds=200, tolerance=1e-9, first=0.9, strength=1.0):
    """Posterior of "good" for every pattern of votes, and each rule's accuracy.

    The accuracy is the chance that a vote is right; an abstention says nothing. Both classes are
    equally likely beforehand, so a document without votes has a posterior of 0.5. `weight` holds
    the number of documents with each pattern. Every accuracy starts at `first` and keeps
    `strength` documents' worth of that belief, which keeps a rule that never votes defined;
    accuracies stay within [0.5, 0.999], so the classes cannot change places.
    """
    vote, weight = np.asarray(vote), np.asarray(weight, float)
    good, bad = vote == GOOD, vote == BAD
    accuracy = np.full(vote.shape[1], first)
    posterior = np.full(len(weight), 0.5)
    for _ in range(rounds):
        gain = np.log(accuracy) - np.log(1 - accuracy)
        posterior = 1 / (1 + np.exp(-((good @ gain) - (bad @ gain))))
        right = (posterior[:, None] * good + (1 - posterior)[:, None] * bad) * weight[:, None]
        cast = ((good | bad) * weight[:, None]).sum(0)
        new = np.clip((right.sum(0) + strength * first) / (cast + strength), 0.5, 0.999)
        moved = np.abs(new - accuracy).max()
        accuracy = new
        if moved < tolerance:
            break
    return posterior, accuracy


def quality_rules(docs: DataFrame, id_col="doc_id", text_col="text", threshold=0.5) -> DataFrame:
    """One row per row of `docs`: id, the counts, the votes' pattern, posterior, base_failed, kept.

    `base_failed` holds for fewer than 10 words, or more than 20 % of the words in windows that
    repeat; such documents are not kept. The others are kept from `threshold` on. A null text
    counts as empty. Repeated rows are judged and counted each; an empty table gives no rows.
    Other columns of `docs` are not read. A document on which all rules abstain has a posterior of
    exactly 0.5; a posterior that equals `threshold` keeps it.
    """

    def measure(batch):
        for a, b, data, borders in w.pieces(batch.column("text")):
            count = counts(data, borders)
            yield {"id": batch.column("id")[a:b], "pattern": pattern_code(votes(count))} | count

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, pattern int, " + ", ".join(f"{c} long" for c in COUNTS)
    measured = staged(map_batches(id_and_text(docs, id_col, text_col), measure, schema), "rules")
    # at most 3 ** len(RULES) rows, a bound that does not grow with the corpus
    found = measured.groupBy("pattern").count().orderBy("pattern").collect()
    codes = np.array([r["pattern"] for r in found], int)
    posterior, _ = estimate(pattern_votes(codes), [r["count"] for r in found])
    judged = docs.sparkSession.createDataFrame(
        [(int(c), round(float(p), 9)) for c, p in zip(codes, posterior)], "pattern int, posterior double"
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return (
        measured.join(F.broadcast(judged), "pattern")
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
        .withColumnRenamed("id", id_col)
    )
