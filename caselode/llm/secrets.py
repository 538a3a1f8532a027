"""Secrets by fixed patterns and by a battery of randomness tests.

The patterns give the base spans. Other candidates are runs of 16 and more letters, digits and `+/_=-`. Each is read in
its inferred encoding, the smallest alphabet that holds its characters, and put to four tests under the
assumption that its symbols are drawn at random: chi-squared uniformity over the alphabet and over the alphabet's classes
(upper case, lower case, digits, others), the number of runs in its lower and upper half, and serial correlation of
neighbours. The least of the four p-values, times four, is the candidate's randomness: keys have one like any other
random string, words and identifiers a small one, the smaller the longer they are.

Which randomness tells a key from text depends on the length. So every document also gives made-up identifiers,
its own words joined in the ways that names, paths and constants are, one of every length class. Their randomness is what
ordinary text reaches; the share of them at least as random as a candidate is its p-value of being ordinary. Weighted
Benjamini-Hochberg over all candidates of all documents bounds the share of false ones among those added; longer
candidates, which carry more evidence, get weights in proportion to their bits.

Texts are read once: counts of both kinds per length class and step of randomness decide the limits.
"""

import hashlib
import math
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselode.session import staged

from . import words as w
from .common import id_and_text, map_batches

KINDS = ("assign", "access", "hex")
#: Kind of the spans that the tests add.
ADDED = "random"
#: Share of false ones among the added spans that is accepted.
FALSE_SHARE = 0.05
#: Characters of a candidate at least; first lengths of the classes.
LEAST, LENGTHS = 16, (16, 20, 24, 32, 40, 48, 64, 96)
#: Randomness 10**-(step / STEPS_A_DIGIT), the last step for all below.
STEPS, STEPS_A_DIGIT = 64, 8

# The patterns of the base spans. A run of 16 and more is what the shorter runs that fail leave.
_ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 12

_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
_WORD = re.compile(r"[A-Za-z]+|[0-9]+")

_DIGIT, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings: the symbols in order of their values, and the classes of the alphabet as sizes. The smallest that fits is taken.
ALPHABETS = (
    ("hex", _DIGIT + "abcdef", (10, 6)), ("HEX", _DIGIT + "ABCDEF", (10, 6)), ("lower", _LOWER, (26,)), ("upper", _UPPER, (26,)),
    ("base32", _UPPER + "234567", (26, 6)), ("lower+digits", _LOWER + _DIGIT, (26, 10)), ("upper+digits", _UPPER + _DIGIT, (26, 10)),
    ("letters", _UPPER + _LOWER, (26, 26)), ("base62", _UPPER + _LOWER + _DIGIT, (26, 26, 10)),
    ("base64", _UPPER + _LOWER + _DIGIT + "+/", (26, 26, 10, 2)), ("base64url", _UPPER + _LOWER + _DIGIT + "-_", (26, 26, 10, 2)),
    ("any", _UPPER + _LOWER + _DIGIT + "+/-_=", (26, 26, 10, 5)),
)
_SETS = [frozenset(a) for _, a, _ in ALPHABETS]
_WIDEST = max(len(a) for _, a, _ in ALPHABETS)


def _tables():
    values = np.zeros((len(ALPHABETS), 256), np.int64)
    classes = np.zeros((len(ALPHABETS), 256), np.int64)
    for k, (_, symbols, sizes) in enumerate(ALPHABETS):
        at = np.frombuffer(symbols.encode(), np.uint8)
        values[k, at] = np.arange(len(symbols))
        classes[k, at] = np.repeat(np.arange(len(sizes)), sizes)
    return values, classes


_VALUES, _CLASSES = _tables()
_SIZES = np.array([len(a) for _, a, _ in ALPHABETS])
_CLASS_SHARE = np.array([[*(s / len(a) for s in sizes), *[0.0] * (4 - len(sizes))] for _, a, sizes in ALPHABETS])


# --- the battery ----------------------------------------------------------------------


def encoding(symbols: str) -> int | None:
    """Number of the smallest alphabet that holds all characters; None for digits alone, which are numbers."""
    chars = set(symbols)
    if chars <= set(_DIGIT):
        return None
    return next((k for k, own in enumerate(_SETS) if chars <= own), len(_SETS) - 1)


def _upper_tail(z):
    """Chance that a standard normal variable exceeds z."""
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z.tolist()])


def _chi_squared_tail(x, df):
    """Chance that a chi-squared variable exceeds x, by the cube root's normal approximation."""
    df = np.maximum(df, 1)
    spread = 2 / (9 * df)
    return _upper_tail((np.cbrt(x / df) - (1 - spread)) / np.sqrt(spread))


def battery(strings: list[str], codes: list[int]) -> np.ndarray:
    """The four p-values (uniformity, classes, runs, serial correlation) of every string in its encoding."""
    count = len(strings)
    if not count:
        return np.empty((0, 4))
    n = np.array([len(s) for s in strings])
    data = np.frombuffer("".join(strings).encode("ascii"), np.uint8)
    of = np.repeat(np.arange(count), n)
    code = np.asarray(codes)
    size = _SIZES[code]
    value, kind = _VALUES[code[of], data], _CLASSES[code[of], data]
    seen = np.bincount(of * _WIDEST + value, minlength=count * _WIDEST).reshape(count, _WIDEST)
    uniform = _chi_squared_tail((seen**2).sum(axis=1) * size / n - n, size - 1)
    share = _CLASS_SHARE[code]
    hits = np.bincount(of * 4 + kind, minlength=count * 4).reshape(count, 4)
    odd = np.divide((hits - share * n[:, None]) ** 2, share * n[:, None], out=np.zeros((count, 4)), where=share > 0)
    n_classes = (share > 0).sum(axis=1)
    classes = np.where(n_classes > 1, _chi_squared_tail(odd.sum(axis=1), n_classes - 1), 1.0)

    inside = np.ones(len(data), bool)
    inside[np.cumsum(n) - n] = False  # a string's first symbol has none before it
    high = 2 * value >= size[of]
    highs = np.bincount(of, high, count)
    changes = np.bincount(of, inside & (high != np.roll(high, 1)), count)
    pairs = highs * (n - highs)
    mean = 2 * pairs / n
    spread = np.sqrt(np.maximum(mean * (mean - 1) / (n - 1), 0))
    away = np.divide(np.abs(changes - mean), spread, out=np.zeros(count), where=spread > 0)
    runs = np.where(pairs > 0, 2 * _upper_tail(away), 0.0)

    centred = value - (np.bincount(of, value, count) / n)[of]
    power = np.bincount(of, centred**2, count)
    product = np.bincount(of, inside * centred * np.roll(centred, 1), count)
    r = np.divide(product, power, out=np.ones(count), where=power > 0)
    serial = 2 * _upper_tail(np.abs(r + 1 / n) * np.sqrt(n))
    return np.minimum(np.stack([uniform, classes, runs, serial], axis=1), 1.0)


def randomness_steps(strings: list[str], codes: list[int]) -> np.ndarray:
    """Step of randomness of every string, 0 for the most random."""
    least = np.clip(battery(strings, codes).min(axis=1, initial=1.0) * 4, 1e-300, 1.0)
    return np.minimum((-np.log10(least) * STEPS_A_DIGIT).astype(np.int64), STEPS - 1)


def length_class(n: int) -> int:
    return bisect_right(LENGTHS, n) - 1


# --- candidates and ordinary strings --------------------------------------------------


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base spans, sorted."""
    out = []
    folded = text.lower()
    if any(name in folded for name in _NAMES):
        out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base) -> list[tuple[int, int, int]]:
    """(start, end, encoding) of the runs that no base span touches; padding at the end is not read."""
    out, k, ends = [], 0, 0
    for m in _CANDIDATE.finditer(text):
        while k < len(base) and base[k][0] < m.end():
            ends = max(ends, base[k][2])
            k += 1
        if ends > m.start():
            continue
        symbols = m[0].rstrip("=")
        if len(symbols) >= LEAST and (code := encoding(symbols)) is not None:
            out.append((m.start(), m.end(), code))
    return out


#: Ways in which words become one string: (what joins them, how a word is written).
_STYLES = (
    ("", str.lower), ("", str.capitalize), ("_", str.lower), ("-", str.lower), ("/", str.lower), ("", str.upper), ("_", str.upper),
)


def ordinary(text: str) -> list[str]:
    """One string per length class, made of consecutive words of the text; a hash of the text says where they start."""
    words = _WORD.findall(text)
    if not words:
        return []
    seed = int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), "big")
    out = []
    for k, first in enumerate(LENGTHS):
        after = LENGTHS[k + 1] if k + 1 < len(LENGTHS) else 2 * first
        own = seed >> (12 * k)
        n, at = first + own % (after - first), own // 64 % len(words)
        glue, write = _STYLES[own // 7 % len(_STYLES)]
        parts, size = [], 0
        while size < n and at < len(words):
            parts.append(write(words[at]))
            size += len(words[at]) + (len(glue) if len(parts) > 1 else 0)
            at += 1
        made = glue.join(parts)[:n]
        if len(made) == n:
            out.append(made)
    return out


# --- limits ---------------------------------------------------------------------------


def limits(candidate_counts: dict, ordinary_counts: dict, share: float = FALSE_SHARE) -> list[int]:
    """For each length class the last step of randomness that is still added, -1 for none.

    Both counts are by (length class, step). Weighted Benjamini-Hochberg: of all candidates, m, those are added whose
    p-value over their weight is at most share * added / m, for the largest such number. Weights go with
    the bits of a class's shortest string and are 1 on average.
    """
    total = sum(candidate_counts.values())
    if not total:
        return [-1] * len(LENGTHS)
    mean = sum(LENGTHS[k] * n for (k, _), n in candidate_counts.items()) / total
    rows = []
    for k, first in enumerate(LENGTHS):
        n_ordinary = sum(ordinary_counts.get((k, s), 0) for s in range(STEPS))
        as_random = 0
        for s in range(STEPS):
            as_random += ordinary_counts.get((k, s), 0)
            p = (1 + as_random) / (1 + n_ordinary)
            rows.append((p * mean / first, k, s, candidate_counts.get((k, s), 0)))
    rows.sort()
    out, added, best = [-1] * len(LENGTHS), 0, 0
    for i, (p, _, _, n) in enumerate(rows):
        added += n
        if p <= share * added / total:
            best = i + 1
    for _, k, s, _ in rows[:best]:
        out[k] = max(out[k], s)
    return out


# --- the operator ---------------------------------------------------------------------

_SPAN = "array<struct<kind:string,start:int,end:int>>"
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_FOUND = "array<struct<start:int,end:int,code:int,size:int,step:int>>"
_ARROW_FOUND = pa.list_(pa.struct([(c, pa.int32()) for c in ("start", "end", "code", "size", "step")]))


def _examine(batch):
    """Base spans, measured candidates and the steps of the ordinary strings of every text."""
    column = batch.column("text")
    for a, b, _, _ in w.pieces(column):
        texts = [column[t].as_py() or "" for t in range(a, b)]
        base = [base_spans(t) for t in texts]
        runs = [candidates(t, own) for t, own in zip(texts, base)]
        plain = [ordinary(t) for t in texts]
        strings = [texts[i][s:e].rstrip("=") for i, own in enumerate(runs) for s, e, _ in own]
        made = [s for own in plain for s in own if encoding(s) is not None]
        steps = iter(randomness_steps(
            strings + made, [c for own in runs for _, _, c in own] + [encoding(s) for s in made]
        ).tolist())
        found = [
            [{"start": s, "end": e, "code": c, "size": length_class(len(texts[i][s:e].rstrip("="))), "step": next(steps)} for s, e, c in own]
            for i, own in enumerate(runs)
        ]
        usual = [[length_class(len(s)) * STEPS + next(steps) for s in own if encoding(s) is not None] for own in plain]
        spans = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in own] for own in base]
        yield {
            "id": batch.column("id")[a:b], "base": pa.array(spans, _ARROW_SPAN), "found": pa.array(found, _ARROW_FOUND),
            "ordinary": pa.array(usual, pa.list_(pa.int32())),
        }


def find_secrets(docs: DataFrame, id_col="doc_id", text_col="text", share: float = FALSE_SHARE) -> DataFrame:
    """One row per row of `docs`: id, base and added spans as arrays of (kind, start, end), and `encodings` of the added.

    Positions count code points, ends are exclusive. A null or empty text has no spans. Rows that repeat give the same
    row each; equal randomness is added or left out together. An empty table gives no rows; other columns are not
    read. Texts of any length are read whole. A table with few documents has too little ordinary text to tell
    random strings by, so nothing is added there.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, base {_SPAN}, found {_FOUND}, ordinary array<int>"
    rows = staged(map_batches(id_and_text(docs, id_col, text_col), _examine, schema), "secrets")
    # at most one row per length class and step comes here
    many = rows.select(F.explode("found").alias("f")).groupBy("f.size", "f.step").count().collect()
    usual = rows.select(F.explode("ordinary").alias("o")).groupBy("o").count().collect()
    last = limits({(r[0], r[1]): r[2] for r in many}, {divmod(r[0], STEPS): r[1] for r in usual}, share)
    limit = F.array(*map(F.lit, last))
    kept = F.filter("found", lambda x: x["step"] <= F.get(limit, x["size"]))
    names = F.array(*(F.lit(name) for name, _, _ in ALPHABETS))
    added = F.transform(kept, lambda x: F.struct(F.lit(ADDED).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return rows.select(
        F.col("id").alias(id_col), "base", added.cast(_SPAN).alias("added"),
        F.transform(kept, lambda x: F.get(names, x["code"])).alias("encodings"),
    )
