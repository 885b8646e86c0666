"""Personal data by weak supervision.

Every document gives candidate spans. Four labelers (shape, gazetteer, context, boundary) vote yes, no or
abstain on each. Expectation-maximisation over the vote patterns of the whole corpus estimates how
reliable each labeler is for each kind, and its posteriors train a logistic span classifier on votes and
span features. Spans of the base patterns are always kept; further candidates (such as a card number that
the base pattern lost because it ran into its neighbour) are kept when the classifier is sure.

The corpus is read once: spans and vote codes go to a table in the shared folder, and a vote pattern is one
of a fixed number of codes, so the table of pattern counts is bounded whatever the corpus.

Defined results: null and empty texts have no spans. Texts are searched whole, in linear time. Offsets are
code points, end exclusive. Repeated rows give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import BATCH_ROWS, bounded_batches, durable, map_columns

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LABELERS = ("shape", "gazetteer", "context", "boundary")
NO, ABSTAIN, YES = range(3)
#: The classifier must be this sure to add a span.
SURE = 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits starts, so the look-behind changes no result and keeps this linear.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Further candidates. An address has at most 64 characters before the sign and 63 in a label by the mail standard.
_HIDDEN_EMAIL = re.compile(r"(?<![\w.])[\w.+-]{1,64}\s?(?:\(at\)|\[at\]|\{at\})\s?[\w-]{1,63}(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\})\s?[A-Za-z0-9-]{2,63}){1,4}")
_IP6 = re.compile(r"(?<![\w:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![\w:])")
_RUN = re.compile(r"(?<![0-9])[0-9]{12,19}(?![0-9])")
_GROUPED = re.compile(r"(?<![0-9])[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])")
_STRICT_PHONE = re.compile(r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")

#: Words of the gazetteers and of the contexts.
MAIL_ENDS = frozenset("com org net edu gov de fr es uk eu info io co biz us ca it nl ch at".split())
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35|30[0-5]|3[68]")
CONTEXT = (
    re.compile(r"\b(?:e-?mail|mail|contact|write to|reach)\b", re.I),
    re.compile(r"\b(?:ip|address|server|host|login|addr)\b", re.I),
    re.compile(r"\b(?:card|visa|mastercard|amex|credit|debit|payment|pay|pan)\b", re.I),
    re.compile(r"\b(?:phone|tel|telephone|call|mobile|fax|cell|whatsapp)\b", re.I),
)
AGAINST = re.compile(r"\b(?:version|isbn|issn|order|section|build|hash|token|sha|md5|commit|serial)\b", re.I)
REACH = 32


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of the base e-mail pattern, found from each at sign outward."""
    out, cur, p = [], 0, text.find("@")
    while p >= 0:
        s = p
        while s > cur and text[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(text, p) if s < p else None
        if m:
            out.append((s, m.end()))
            cur = m.end()
        p = text.find("@", max(p + 1, cur))
    return out


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def octet(digits: str) -> bool:
    """Whether a run of digits of any length, leading zeros included, is at most 255."""
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, in order of start and kind."""
    out = [(EMAIL, s, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(IP, m.start(), m.end()) for m in _IP.finditer(text) if all(map(octet, m.groups()))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                d = digits_of(m[0])
                if 12 <= len(d) <= 19 and luhn(d):
                    out.append((CARD, m.start(), m.end()))
        if "+" in text:
            out += [(PHONE, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[1], x[0]))


def further(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that the base patterns lose and that overlap none of their spans."""
    found: list[tuple[int, int, int]] = []
    if "at" in text and ("(at)" in text or "[at]" in text or "{at}" in text):
        found += [(EMAIL, m.start(), m.end()) for m in _HIDDEN_EMAIL.finditer(text)]
    if _DIGIT.search(text):
        if text.count(":") >= 7:
            found += [(IP, m.start(), m.end()) for m in _IP6.finditer(text)]
        found += [(CARD, m.start(), m.end()) for p in (_RUN, _GROUPED) for m in p.finditer(text)]
        found += [(PHONE, m.start(), m.end()) for p in (_STRICT_PHONE, _LOCAL_PHONE) for m in p.finditer(text)]
    taken = sorted((s, e) for _, s, e in base)
    out: list[tuple[int, int, int]] = []
    for k, s, e in sorted(found, key=lambda x: (x[1], -x[2], x[0])):
        if out and s < out[-1][2]:
            continue
        lo, hi = 0, len(taken)
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if taken[mid][1] <= s else (lo, mid)
        if lo == len(taken) or taken[lo][0] >= e:
            out.append((k, s, e))
    return out


def votes(text: str, kind: int, s: int, e: int) -> list[int]:
    """One vote of each labeler."""
    span, d = text[s:e], digits_of(text[s:e])
    if kind == EMAIL:
        shape = YES if "@" in span else ABSTAIN
        gaz = YES if re.split(r"[^A-Za-z0-9]+", span.lower())[-1] in MAIL_ENDS else NO
    elif kind == IP:
        shape = YES if ":" in span or all(p == "0" or p[0] != "0" for p in span.split(".")) else NO
        gaz = ABSTAIN if ":" in span else NO if span.split(".")[0] in ("0", "127", "255") else YES
    elif kind == CARD:
        shape = YES if luhn(d) else NO
        gaz = YES if ISSUERS.match(d) and len(d) in (13, 14, 15, 16, 19) else NO
    else:
        shape = YES if _STRICT_PHONE.fullmatch(span) or _LOCAL_PHONE.fullmatch(span) else ABSTAIN if span[0] == "+" else NO
        gaz = YES if span[0] == "+" and len(d) >= 10 else ABSTAIN
    before = text[max(0, s - REACH) : s]
    context = YES if CONTEXT[kind].search(before) else NO if AGAINST.search(before) else ABSTAIN
    boundary = NO if (s and (text[s - 1].isalnum() or text[s - 1] == "_")) or (e < len(text) and (text[e].isalnum() or text[e] == "_")) else YES
    return [shape, gaz, context, boundary]


def code(text: str, kind: int, s: int, e: int) -> int:
    """Kind, votes and two span features in one small number (at most 4 * 81 * 8)."""
    n = 0
    for v in votes(text, kind, s, e):
        n = n * 3 + v
    long, spaced = min((e - s) // 8, 3), int(" " in text[s:e])
    return (kind * 81 + n) * 8 + long * 2 + spaced


def decode(c: int) -> tuple[int, list[int], int, int]:
    f, rest = c % 8, c // 8
    n, kind = rest % 81, rest // 81
    out = []
    for _ in LABELERS:
        out.append(n % 3)
        n //= 3
    return kind, out[::-1], f // 2, f % 2


def reliabilities(counts: dict[int, int], rounds: int = 50) -> tuple[dict[int, float], np.ndarray]:
    """EM over vote patterns. Returns the posterior of each code and P(vote | kind, labeler, class)."""
    codes = sorted(counts)
    if not codes:
        return {}, np.full((4, 4, 2, 3), 1 / 3)
    parts = [decode(c) for c in codes]
    kind = np.array([p[0] for p in parts])
    vote = np.array([p[1] for p in parts])
    n = np.array([counts[c] for c in codes], dtype=float)
    yes, no = (vote == YES).sum(1), (vote == NO).sum(1)
    q = (1 + 2 * yes) / (2 + 2 * yes + 2 * no)  # a smoothed majority to start from
    table = np.zeros((4, 4, 2, 3))
    for _ in range(rounds):
        prior = np.zeros(4)
        for k in range(4):
            own = kind == k
            prior[k] = ((n * q)[own].sum() + 1) / (n[own].sum() + 2)
            for j in range(4):
                for v in range(3):
                    hit = own & (vote[:, j] == v)
                    table[k, j, 1, v] = (n * q)[hit].sum() + (2.0 if v == YES else 0.5)
                    table[k, j, 0, v] = (n * (1 - q))[hit].sum() + (2.0 if v == NO else 0.5)
        table /= table.sum(3, keepdims=True)
        logs = np.stack([np.log(table[kind, j, :, vote[:, j]]) for j in range(4)]).sum(0)
        odds = logs[:, 1] - logs[:, 0] + np.log(prior[kind] / (1 - prior[kind]))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - q).max() < 1e-9:
            break
        q = new
    return dict(zip(codes, q.tolist(), strict=True)), table


def features(c: int) -> np.ndarray:
    kind, vote, long, spaced = decode(c)
    x = np.zeros(1 + 4 + 12 + 4 + 1)
    x[0], x[1 + kind] = 1, 1
    for j, v in enumerate(vote):
        x[5 + 3 * j + v] = 1
    x[17 + long], x[21] = 1, spaced
    return x


def train(counts: dict[int, int], posterior: dict[int, float], ridge: float = 1.0) -> np.ndarray:
    """Logistic weights by Newton's method on the expected labels, each pattern weighted by its count."""
    w = np.zeros(22)
    if not counts:
        return w
    codes = sorted(counts)
    x = np.stack([features(c) for c in codes])
    n = np.array([counts[c] for c in codes], dtype=float)
    n *= min(1.0, 1e6 / n.max())  # one factor for all, so that proportions stay and the steps can be solved
    y = np.array([posterior[c] for c in codes])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (y - p)) - ridge * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(22)
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def accepted(counts: dict[int, int], sure: float = SURE) -> set[int]:
    """Codes whose further candidates become spans: those that the classifier is sure of."""
    posterior, _ = reliabilities(counts)
    w = train(counts, posterior)
    return {c for c in counts if 1 / (1 + np.exp(-np.clip(features(c) @ w, -30, 30))) >= sure}


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], x[0])))


def candidates(df: DataFrame) -> DataFrame:
    """doc_id, base and further: flat arrays of kind, start, end and code for each row of df (doc_id, text)."""

    def make():
        def run(ids, texts):
            base, more = [], []
            for t in texts:
                t = t or ""
                b = base_spans(t)
                base.append([x for k, s, e in b for x in (k, s, e, code(t, k, s, e))])
                more.append([x for k, s, e in further(t, b) for x in (k, s, e, code(t, k, s, e))])
            return ids, base, more

        return run

    return map_columns(df, ("doc_id", "text"), "doc_id long, base array<int>, further array<int>", make)


def pattern_counts(found: DataFrame) -> dict[int, int]:
    """How often each code occurs in the whole corpus; at most 2,592 rows reach the driver."""
    spans = found.select(F.concat("base", "further").alias("x")).filter(F.size("x") > 0)
    codes = spans.select(F.explode(F.expr("transform(sequence(3, size(x) - 1, 4), i -> x[i])")).alias("code"))
    return {r["code"]: r["n"] for r in codes.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}


def _quads(x: list[int]) -> list[tuple[int, int, int, int]]:
    return list(zip(x[::4], x[1::4], x[2::4], x[3::4], strict=True))


def find_pii(df: DataFrame, sure: float = SURE) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans of each row of df (doc_id, text)."""
    found = durable(candidates(df), "pii-candidates")
    good = frozenset(accepted(pattern_counts(found), sure))

    def make():
        def run(ids, base, more):
            counts: list[list[int]] = [[], [], [], []]
            digest, spans = [], []
            for b, m in zip(base, more, strict=True):
                own = [q[:3] for q in _quads(b)]
                for k in range(4):
                    counts[k].append(sum(x[0] == k for x in own))
                digest.append(hashlib.sha256(joined(own).encode()).hexdigest())
                spans.append(joined(own + [q[:3] for q in _quads(m) if q[3] in good]))
            return ids, *counts, digest, spans

        return run

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_columns(found, ("doc_id", "base", "further"), schema, make, 4096)


def redact_text(text: str | None, good: frozenset[int]) -> str | None:
    """The text with each span (overlaps joined) replaced by its kind in square brackets."""
    if not text:
        return text
    base = base_spans(text)
    spans = base + [x for x in further(text, base) if code(text, *x) in good]
    out, at = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], x[0])):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:] if out else text


def redact(df: DataFrame, sure: float = SURE) -> DataFrame:
    """df with personal data in `text` replaced and n_chars, where df has it, counted anew; all rows and columns stay.

    The corpus is read twice, once for the vote patterns and once to write; no text is moved between tasks.
    """
    good = frozenset(accepted(pattern_counts(candidates(df)), sure))
    names = df.columns
    at, sizes = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, BATCH_ROWS):
                b = whole.slice(k, BATCH_ROWS)
                columns = list(b.columns)
                new = [redact_text(t, good) for t in columns[at].to_pylist()]
                columns[at] = pa.array(new, columns[at].type)
                if sizes is not None:
                    columns[sizes] = pa.array([None if t is None else len(t) for t in new], columns[sizes].type)
                yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)
