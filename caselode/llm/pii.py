"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns give the base spans. The random field looks at the tokens around digits and @ signs: it
splits them into segments, each either one outside token or a whole candidate entity, scores candidates
by features of the whole span and of its borders, and picks the best segmentation by dynamic
programming over entities of bounded length. Base spans are fixed segments of it; what it finds besides,
such as a card number inside a longer run of digits, is added.

Its weights are trained on documents of the corpus, drawn by the kinds of their base spans, which are the labels.
"""

import math
import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselode.session import staged

from . import words as w
from .common import id_and_text, map_batches

KINDS = ("email", "ip", "card", "phone")
#: Documents that the field is trained on, at most: of each kind those with a base span of it, and those with
#: digits or @ and no base span; the ones with the smallest hash of id and text.
KIND_DOCS, SPANLESS_DOCS = 100, 200
#: Of one of them, zones that are trained on (with a span, and without), and tokens of a zone.
TRAIN_ZONES, ZONE_TOKENS = 16, 256
#: Tokens of one entity, and tokens on either side of a digit or @ that belong to its zone.
MOST_TOKENS, MARGIN = 16, 2
#: How much better than outside an added span must score.
LEAST_GAIN = 1.0
EPOCHS, RATE, DECAY = 150, 0.2, 0.004

# The patterns of the base spans. Possessive runs and borders keep them linear; they
# match what the plain forms `[0-9]+(\.[0-9]+){3}` and so on match.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_TOKEN = re.compile(r"[0-9]+|[^\W0-9_]+|\S")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _byte(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def _only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def _emails(text):
    """Every @ takes the local part before it, back to the last match's end, and a domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        else:
            end = max(end, at + 1)
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base spans, sorted."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(map(_byte, m[0].split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _only_digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_only_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


FEATURES = [f"{kind}:{name}" for kind in KINDS for name in (
    "bias", "joined_before", "joined_after", "tokens", "strong", "shape", "count", "marked", "even",
)] + ["entity_after_entity"]
_AT = {f: i for i, f in enumerate(FEATURES)}
_PER_KIND = 9
#: Weights before any training, in the order of the features of a kind: towards these they are held.
PRIOR = (-2.0, -2.0, -2.0, 0.0, 1.0, 1.0, 1.0, 1.0, 1.0)


def zones(text: str):
    """Lists of tokens (start, end) around digits and @ signs; every such token is in one zone."""
    tokens, marked = [], []
    for m in _TOKEN.finditer(text):
        c = text[m.start()]
        if "0" <= c <= "9" or c == "@":
            marked.append(len(tokens))
        tokens.append(m.span())
    out, i = [], 0
    while i < len(marked):
        first, end = marked[i], marked[i]
        while True:  # marked tokens near by, and what is joined to them without a space
            if i + 1 < len(marked) and marked[i + 1] - end <= 2 * MARGIN:
                i += 1
                end = marked[i]
            elif end + 1 < len(tokens) and tokens[end + 1][0] == tokens[end][1] and end - marked[i] < MOST_TOKENS:
                end += 1
            else:
                break
        before = first
        while before and tokens[before - 1][1] == tokens[before][0] and first - before < MOST_TOKENS:
            before -= 1
        out.append(tokens[max(0, before - MARGIN) : end + MARGIN + 1])
        i += 1
    return out


def candidates(text, tokens):
    """(first token, token after the last, kind, features) of what may be an entity in a zone.

    Spans start at every token; an entity has at most MOST_TOKENS tokens and the characters of its kind.
    """
    out = []
    for i, (start, _) in enumerate(tokens):
        c = text[start]
        digit = "0" <= c <= "9"
        if not (digit or c in "+(" or c in _LOCAL):
            continue
        n_digits, number = 0, digit or c in "+("
        for j in range(i, min(len(tokens), i + MOST_TOKENS)):
            a, b = tokens[j]
            gap = text[tokens[j - 1][1] : a] if j > i else ""
            last = text[a]
            last_digit = "0" <= last <= "9"
            number = number and (last_digit or last in "()+.-") and gap in ("", " ")
            if number:
                n_digits += b - a if last_digit else 0
                if last_digit and n_digits <= 19 and j > i or last_digit and 12 <= n_digits <= 19:
                    span = text[start:b]
                    if digit and j - i == 6 and " " not in span and span.count(".") == 3 and all(map(_byte, span.split("."))):
                        out.append((i, j + 1, 1, _ip_features(text, start, b, span)))
                    if digit and 12 <= n_digits and not set(span) - set("0123456789 -") and luhn(_only_digits(span)):
                        out.append((i, j + 1, 2, _card_features(text, start, b, span, j + 1 - i)))
                    if 7 <= n_digits <= 15 and span.find("+", 1) < 0:
                        out.append((i, j + 1, 3, _phone_features(text, start, b, span, j + 1 - i)))
                if n_digits > 19:
                    number = False
            if c in _LOCAL:
                if gap:
                    if not number:
                        break
                elif j > i and (last_digit or last.isalpha()) and "@" in (span := text[start:b]):
                    if (found := _email_features(text, start, b, span)) is not None:
                        out.append((i, j + 1, 0, found))
            elif not number:
                break
    return out


def _row(kind, text, start, end, tokens, strong, shape, count, marked, even):
    """Feature numbers and values of a whole span."""
    before, after = text[start - 1 : start], text[end : end + 1]
    joined = lambda c: bool(c) and (c.isalnum() or c in "+-_/=@")
    dotted_digit = text[end : end + 1] in (".", "-") and text[end + 1 : end + 2].isdigit()
    digit_before = text[start - 1 : start] in (".", "-") and text[start - 2 : start - 1].isdigit()
    values = (1.0, joined(before) or digit_before, joined(after) or dotted_digit, tokens / MOST_TOKENS, strong, shape, count, marked, even)
    base = kind * _PER_KIND
    return [(base + i, float(v)) for i, v in enumerate(values) if v]


def _email_features(text, start, end, span):
    local, _, domain = span.partition("@")
    if not local or not domain or set(local) - _LOCAL or not _DOMAIN.fullmatch(domain):
        return None
    top = domain.rsplit(".", 1)[1]
    return _row(0, text, start, end, 0, top.isalpha() and len(top) >= 2, local[0].isalnum(), domain.count(".") >= 1, 1, 0)


def _ip_features(text, start, end, span):
    parts = span.split(".")
    return _row(1, text, start, end, 0, 0, not any(len(p) > 1 and p[0] == "0" for p in parts), 0, 0, 0)


def _card_features(text, start, end, span, tokens):
    digits = _only_digits(span)
    groups = [len(g) for g in re.split("[ -]", span)]
    even = len(groups) == 1 or set(groups[:-1]) == {4} or groups == [4, 6, 5]
    return _row(2, text, start, end, tokens, luhn(digits), digits[0] in "3456", len(digits) in (15, 16), 0, even)


def _phone_features(text, start, end, span, tokens):
    digits = _only_digits(span)
    groups = [len(g) for g in re.findall("[0-9]+", span)]
    national = groups[-3:] == [3, 3, 4] or groups[-2:] == [3, 4]
    paired = span.count("(") == span.count(")") and span[-1] != "("
    return _row(3, text, start, end, tokens, national, paired and len(groups) > 1, len(digits) >= 9, span[0] == "+", "(" in span)


def _log_sum(a, b):
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


class Field:
    """The semi-Markov random field: a weight for every feature."""

    prior = np.array([*PRIOR * len(KINDS), 0.0])

    def __init__(self, weights=None):
        self.weights = self.prior if weights is None else np.asarray(weights, float)

    def score(self, features):
        return sum(self.weights[i] * v for i, v in features)

    def segment(self, n_tokens, found, fixed=()):
        """Best segmentation of a zone: the chosen candidates, as their numbers.

        `fixed` are token ranges that are segments already; nothing may overlap them.
        """
        taken = np.zeros(n_tokens, bool)
        for a, b in fixed:
            taken[a:b] = True
        ending = {}
        for k, (i, j, _, features) in enumerate(found):
            gain = self.score(features)
            if gain > LEAST_GAIN and not taken[i:j].any():
                ending.setdefault(j, []).append((k, i, gain))
        follow = self.weights[_AT["entity_after_entity"]]
        # per border: the best score with an outside token last, and with an entity last
        best = [[0.0, -math.inf]]
        back = [[None, None]]
        for t in range(1, n_tokens + 1):
            outside, entity = max(best[t - 1]), -math.inf
            came, chosen = int(best[t - 1][1] > best[t - 1][0]), None
            for k, i, gain in ending.get(t, ()):
                for state, value in enumerate(best[i]):
                    total = value + gain + (follow if state else 0.0)
                    if total > entity:
                        entity, chosen = total, (k, i, state)
            best.append([outside, entity])
            back.append([came, chosen])
        t, state, out = n_tokens, int(best[-1][1] > best[-1][0]), []
        while t > 0:
            if state:
                k, t, state = back[t][1]
                out.append(k)
            else:
                t, state = t - 1, back[t][0]
        return out[::-1]

    def gradient(self, n_tokens, found, gold):
        """Log-likelihood of the gold candidates (numbers) of one zone, and its gradient."""
        scores = [self.score(f) for _, _, _, f in found]
        follow = self.weights[_AT["entity_after_entity"]]
        starting, ending = {}, {}
        for k, (i, j, _, _) in enumerate(found):
            starting.setdefault(i, []).append(k)
            ending.setdefault(j, []).append(k)
        none = -math.inf
        forward = [(0.0, none)]
        for t in range(1, n_tokens + 1):
            entity = none
            for k in ending.get(t, ()):
                o, e = forward[found[k][0]]
                entity = _log_sum(entity, scores[k] + _log_sum(o, e + follow))
            forward.append((_log_sum(*forward[t - 1]), entity))
        backward = [None] * (n_tokens + 1)
        backward[n_tokens] = (0.0, 0.0)
        for t in range(n_tokens - 1, -1, -1):
            outside, entity = backward[t + 1][0], none
            for k in starting.get(t, ()):
                entity = _log_sum(entity, scores[k] + backward[found[k][1]][1])
            backward[t] = (_log_sum(outside, entity), _log_sum(outside, entity + follow))
        whole = backward[0][0]
        grad = np.zeros(len(FEATURES))
        log = -whole
        chosen = set(gold)
        for k, (i, j, _, features) in enumerate(found):
            o, e = forward[i]
            after_entity = e + follow + scores[k] + backward[j][1] - whole
            p = math.exp(_log_sum(o + scores[k] + backward[j][1] - whole, after_entity))
            follows = math.exp(after_entity) if after_entity > -700 else 0.0
            for f, v in features:
                grad[f] -= p * v
            grad[_AT["entity_after_entity"]] -= follows
            if k in chosen:
                log += scores[k]
                for f, v in features:
                    grad[f] += v
        ends = {found[k][1] for k in chosen}
        pairs = sum(found[k][0] in ends for k in chosen)
        grad[_AT["entity_after_entity"]] += pairs
        return log + pairs * follow, grad


def _in_zone(tokens, spans):
    """Token ranges of the spans that lie in the zone."""
    starts, ends = {a: i for i, (a, _) in enumerate(tokens)}, {b: i + 1 for i, (_, b) in enumerate(tokens)}
    for start, kind, end in spans:
        i, j = starts.get(start), ends.get(end)
        if i is None or j is None:  # it starts or ends inside a token: what it touches is its own
            touched = [t for t, (a, b) in enumerate(tokens) if a < end and b > start]
            i, j = (touched[0], touched[-1] + 1) if touched else (None, None)
        if i is not None:
            yield i, j, kind


def examples(text: str) -> list:
    """(number of tokens, candidates, gold candidates) of a bounded number of a text's zones, the first ones."""
    spans, out, room = base_spans(text), [], [TRAIN_ZONES, TRAIN_ZONES]
    for zone in zones(text):
        tokens = zone[:ZONE_TOKENS]
        found = candidates(text, tokens)
        if not found:
            continue
        number = {(i, j, kind): k for k, (i, j, kind, _) in enumerate(found)}
        gold, at = [], 0
        whole = [s for s in spans if tokens[0][0] <= s[0] and s[2] <= tokens[-1][1]]
        for key in sorted(_in_zone(tokens, whole)):
            if key in number and key[0] >= at:  # spans of two kinds may overlap: the first counts
                gold.append(number[key])
                at = key[1]
        if room[bool(gold)]:
            room[bool(gold)] -= 1
            out.append((len(tokens), found, gold))
        if not any(room):
            break
    return out


def train(found) -> Field:
    """A field fitted to examples; without any it keeps the weights that it has before training."""
    field = Field()
    for _ in range(EPOCHS if found else 0):
        grad = DECAY * (Field.prior - field.weights)
        for example in found:
            grad = grad + field.gradient(*example)[1] / len(found) * 10
        field.weights = field.weights + RATE * grad / max(1.0, np.abs(grad).max() / 5)
    return field


def all_spans(text, field) -> tuple[list, list]:
    """(base spans, added spans), both as (start, kind number, end)."""
    base = base_spans(text)
    if field is None:
        return base, []
    added = []
    for tokens in zones(text):
        found = candidates(text, tokens)
        if found:
            fixed = [(i, j) for i, j, _ in _in_zone(tokens, base)]
            for k in field.segment(len(tokens), found, fixed):
                i, j, kind, _ = found[k]
                added.append((tokens[i][0], kind, tokens[j - 1][1]))
    return base, added


def spans_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _marked_texts(column):
    """Positions of the texts with a digit or @."""
    marks = np.zeros(256, bool)
    marks[[0x40, *range(0x30, 0x3A)]] = True
    for a, _, data, borders in w.pieces(column):
        yield from (a + np.flatnonzero(w.per_text(marks[data], borders))).tolist()


def trained_field(docs: DataFrame, id_col="doc_id", text_col="text") -> Field | None:
    """A field trained on a bounded number of documents of the corpus, drawn alike at every size.

    All documents are searched for base spans, so kinds that are rare are in the draw. Only the features of
    a bounded number of zones reach the driver. If no document has a span, the field is the prior one;
    None if no document has a digit or @, so that there is nothing to find.
    """
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.select(F.xxhash64("id", "text", F.lit("pii")).alias("key"), "text")

    def kinds(batch):
        column = batch.column("text")
        at = list(_marked_texts(column))
        masks = [sum({1 << kind for _, kind, _ in base_spans(column[t].as_py())}) for t in at]
        yield {"key": batch.column("key").take(pa.array(at, pa.int64())), "kinds": masks}

    marked = staged(map_batches(rows, kinds, "key long, kinds int").distinct(), "pii-kinds")
    draws = [(F.col("kinds").bitwiseAND(1 << k) != 0, KIND_DOCS) for k in range(len(KINDS))]
    drawn = set()
    for wanted, most in [*draws, (F.col("kinds") == 0, SPANLESS_DOCS)]:
        drawn.update(r["key"] for r in marked.filter(wanted).orderBy("key").limit(most).collect())
    if not drawn:
        return None

    def learn(batch):
        column = batch.column("text")
        yield {"key": batch.column("key"), "found": [pickle.dumps(examples(t.as_py())) for t in column]}

    some = rows.filter(F.col("key").isin(sorted(drawn)))
    found = {r["key"]: r["found"] for r in map_batches(some, learn, "key long, found binary").dropDuplicates(["key"]).collect()}
    zones_found = [x for key in sorted(found) for x in pickle.loads(found[key])]
    return train(zones_found if any(gold for _, _, gold in zones_found) else [])


def find_pii(docs: DataFrame, field: Field | None, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row of `docs`: id, base and added spans as arrays of (kind, start, end) in order.

    Positions count code points, ends are exclusive. A null or empty text has no spans. Rows that
    repeat give the same row each; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    id_type = docs.schema[id_col].dataType.simpleString()
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def find(batch):
        known = shared.value
        marks = np.zeros(256, bool)
        marks[[0x40, *range(0x30, 0x3A)]] = True
        column = batch.column("text")
        for a, b, data, borders in w.pieces(column):
            base, added = [()] * (b - a), [()] * (b - a)
            for t in np.flatnonzero(w.per_text(marks[data], borders)).tolist():
                base[t], added[t] = all_spans(column[a + t].as_py(), known)
            rows = lambda x: pa.array(
                [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(own)] for own in x], item
            )
            yield {"id": batch.column("id")[a:b], "base": rows(base), "added": rows(added)}

    span = "array<struct<kind:string,start:int,end:int>>"
    out = map_batches(id_and_text(docs, id_col, text_col), find, f"id {id_type}, base {span}, added {span}")
    return out.withColumnRenamed("id", id_col)
