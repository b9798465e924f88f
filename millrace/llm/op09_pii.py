"""Personal data: patterns, and a linear-chain conditional random field over word shapes.

The field is fitted on the driver from a small labelled table of word sequences (a parameter;
labelled_table() builds the default by rule) and decoded by Viterbi in numpy batches. It labels
words as email, ip, card or phone by their shape and their neighbours' and so finds what the
patterns miss: numbers in unusual grouping, or without a check digit. Its spans are added where
no pattern's span lies; the patterns' spans always stay.

A sequence is a piece of a line that ends with a word in ".", "!" or "?", or with the line.
Sequences of which no character is a digit or one of @ + - ( ) are not decoded: for them the best labelling is
known to name nothing, which fit() proves from the weights (otherwise all are decoded).

Rows are scanned by themselves: no shuffle. Memory holds CHUNK_CHARS characters or the longest
text; all patterns take linear time.

Cases: a null or empty text has no spans; null ids and repeated rows are scanned like others; an
empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import chunks, code_points, pick, spans_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
CHUNK_CHARS = 500_000

# The contract's patterns. Starts inside a run of digits are left out where the run's first
# digit would do as well, and runs never give digits back, so that long runs take linear time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, int]  # start, number of the kind, end


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, 0, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[::-2]))
    return (odd + sum(d // 5 + d * 2 % 10 for d in map(int, digits[-2::-2]))) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The contract's spans, by start, then kind."""
    found: list[Span] = list(_emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() > 11:
            digits = _NO_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def written(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# --- the conditional random field -----------------------------------------------------------

# Character classes of the features; 0 is all else.
DIGIT, LOWER, UPPER, AT, DOT, DASH, PLUS, BRACKET, MARK = range(1, 10)
# Marks at a word's edges that do not belong to a span.
EDGE = "\"'.,;:!?#$%&*<>[]{}|`~«»“”‘’=/_"


# Without a character of these classes a word is plain.
_TELLING = np.zeros(10, bool)
_TELLING[[DIGIT, AT, DASH, PLUS, BRACKET]] = True


def _class_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for chars, kind in (("0123456789", DIGIT), ("@", AT), (".", DOT), ("-", DASH), ("+", PLUS),
                        ("()", BRACKET), (EDGE.replace(".", ""), MARK)):
        for c in chars:
            table[ord(c)] = kind
    table[ord("a") : ord("z") + 1] = LOWER
    table[ord("A") : ord("Z") + 1] = UPPER
    table[0xC0:0x250] = LOWER
    return table


_CLASSES = _class_table()
_IS_EDGE = np.zeros(0x110000, bool)
_IS_EDGE[[ord(c) for c in EDGE]] = True
_SENTENCE_END = np.zeros(0x110000, bool)
_SENTENCE_END[[ord(c) for c in ".!?"]] = True
_SPACE = np.zeros(0x110000, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def shapes(points: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A row of 0 and 1 for each word: what its shape is. The first column is always 1."""
    if not len(first):
        return np.zeros((0, N_SHAPES), np.float32)
    classes = _CLASSES[points]
    edges = np.stack([first, end], axis=1).ravel()
    n: dict[int, np.ndarray] = {}
    for kind in (DIGIT, LOWER, UPPER, AT, DOT, DASH, PLUS, BRACKET, MARK):
        hit = np.append(classes == kind, False)
        n[kind] = np.add.reduceat(hit, edges, dtype=np.int32)[::2]
    digits, letters, length = n[DIGIT], n[LOWER] + n[UPPER], end - first
    inner_dots = n[DOT] - _SENTENCE_END[points[end - 1]]
    opens = classes[first]
    numeric = (digits > 0) & (letters == 0)
    columns = [
        np.ones(len(first), bool),
        digits == 0,
        numeric,
        (digits > 0) & (letters > 0),
        n[AT] > 0,
        (n[AT] > 0) & (inner_dots > 0) & (letters > 0),
        numeric & (inner_dots >= 3) & (digits >= 4) & (digits <= 12) & (n[AT] == 0),
        numeric & (inner_dots > 0) & (inner_dots < 3),
        opens == PLUS,
        (opens == PLUS) & numeric,
        n[BRACKET] > 0,
        (n[BRACKET] > 0) & numeric & (digits <= 4),
        n[DASH] > 0,
        numeric & (n[DASH] > 0) & (digits >= 6) & (digits <= 11),
        numeric & (digits <= 2),
        numeric & (digits == 3),
        numeric & (digits == 4),
        numeric & (digits >= 5) & (digits <= 11) & (n[DASH] == 0),
        numeric & (digits >= 12) & (digits <= 19),
        digits > 19,
        length > 30,
        n[MARK] > 1,
        (opens == UPPER) & (digits == 0),
        _SENTENCE_END[points[end - 1]],
    ]
    return np.stack(columns, axis=1).astype(np.float32)


N_SHAPES = 24


class Field(NamedTuple):
    """Weights of a word's own shape, of the ones before and after, and of label pairs."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    pairs: np.ndarray
    first: np.ndarray
    plain_is_none: bool


def emissions(x: np.ndarray, begins: np.ndarray, field: Field) -> np.ndarray:
    """Scores of all labels for each word; begins marks the first words of sequences."""
    e = x @ field.own
    if len(x) > 1:
        inner = ~begins[1:, None]
        e[1:] += np.where(inner, x[:-1] @ field.before, 0)
        e[:-1] += np.where(inner, x[1:] @ field.after, 0)
    e[begins] += field.first
    return e


def viterbi(e: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The best labels of all words; sequences are decoded side by side, longest first."""
    labels = np.zeros(len(e), np.int64)
    if not len(e):
        return labels
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    back = np.zeros(e.shape, np.int8)
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    score = e[starts].copy()
    for t in range(1, lengths[0]):
        k = active[t]
        through = score[:k, :, None] + pairs
        best = through.argmax(axis=1)
        back[starts[:k] + t] = best
        score[:k] = np.take_along_axis(through, best[:, None, :], 1)[:, 0] + e[starts[:k] + t]
    now = score.argmax(axis=1)
    for t in range(lengths[0] - 1, -1, -1):
        k = active[t]
        labels[starts[:k] + t] = now[:k]
        if t:
            now[:k] = back[starts[:k] + t, now[:k]]
    return labels


def _sequences(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words (first, end) and whether each begins a sequence."""
    first, end = spans_of(~_SPACE[points], starts)
    if not len(first):
        return first, end, np.zeros(0, bool)
    begins = np.zeros(len(first), bool)
    begins[0] = True
    lines = np.cumsum(points == 10)
    begins[1:] = lines[first[1:]] != lines[first[:-1]]
    begins[1:] |= _SENTENCE_END[points[end[:-1] - 1]]
    begins[1:] |= np.searchsorted(starts, first[1:], "right") != np.searchsorted(
        starts, first[:-1], "right"
    )
    return first, end, begins


def field_spans(texts: list[str], field: Field) -> list[list[Span]]:
    """What the field finds in each text: words of one label in a row, without edge marks."""
    found: list[list[Span]] = [[] for _ in texts]
    points, starts = code_points(texts)
    first, end, begins = _sequences(points, starts)
    if not len(first):
        return found
    if field.plain_is_none:
        telling = np.append(_TELLING[_CLASSES[points]], False)
        edges = np.stack([first, end], axis=1).ravel()
        special = np.logical_or.reduceat(telling, edges)[::2]
        number = np.cumsum(begins) - 1
        keep = (np.bincount(number, special) > 0)[number]
        first, end, begins = first[keep], end[keep], begins[keep]
        if not len(first):
            return found
    at = np.flatnonzero(begins)
    labels = viterbi(
        emissions(shapes(points, first, end), begins, field), at,
        np.diff(np.append(at, len(first))), field.pairs,
    )
    named = np.flatnonzero(labels)
    if not len(named):
        return found
    joins = (np.diff(named) == 1) & (np.diff(labels[named]) == 0) & ~begins[named[1:]]
    opens = np.flatnonzero(np.append(True, ~joins))
    closes = np.append(opens[1:], len(named)) - 1
    for a, b in zip(named[opens], named[closes]):
        s, e = int(first[a]), int(end[b])
        while s < e and _IS_EDGE[points[s]]:
            s += 1
        while e > s and _IS_EDGE[points[e - 1]]:
            e -= 1
        if s < e:
            doc = int(np.searchsorted(starts, s, "right")) - 1
            found[doc].append((s - int(starts[doc]), int(labels[a]) - 1, e - int(starts[doc])))
    return found


def labelled_table(n: int = 400, seed: int = 7) -> list[tuple[list[str], list[int]]]:
    """The default labelled table: word sequences with a label a word, built by rule.

    Frames of ordinary words hold either personal data in many writings or numbers that are
    none: versions, years, prices, dates, short counts and hexadecimal digests.
    """
    rng = np.random.default_rng(seed)
    syllables = "an be co de er in la mo nt or pa re so ti un ve wh ou th st".split()

    def digits(k: int) -> str:
        return "".join(map(str, rng.integers(0, 10, k)))

    def word() -> str:
        w = "".join(rng.choice(syllables, rng.integers(1, 4)))
        w = w.capitalize() if rng.random() < 0.2 else w.upper() if rng.random() < 0.1 else w
        return w + str(rng.choice(["", "", "", "", ",", "%%%", "***", "!!", "&&&"]))

    def email() -> list[str]:
        return [f"{word().strip(',%*!&')}.{digits(2)}@{word().strip(',%*!&')}{digits(1)}.example.com"]

    def ip() -> list[str]:
        return [".".join(str(rng.integers(0, 256)) for _ in range(4))]

    def card() -> list[str]:
        if rng.random() < 0.5:
            return [digits(int(rng.choice([13, 15, 16, 16, 16, 19])))]
        if rng.random() < 0.5:
            return [digits(4) for _ in range(4)]
        return ["-".join(digits(4) for _ in range(4))]

    def phone() -> list[str]:
        kind = rng.integers(0, 5)
        if kind == 0:
            return [f"+{digits(1)}", f"({digits(3)})", f"{digits(3)}-{digits(4)}"]
        if kind == 1:
            return [f"+{digits(2)}", digits(3), digits(3), digits(3)]
        if kind == 2:
            return [f"({digits(3)})", f"{digits(3)}-{digits(4)}"]
        if kind == 3:
            return [f"+{digits(11)}"]
        return [f"{digits(3)}-{digits(3)}-{digits(4)}"]

    def harmless() -> list[str]:
        kind = rng.integers(0, 9)
        return [
            ["version", f"{digits(1)}."], ["CC", "BY-NC", f"{digits(1)}.{digits(1)}."],
            [f"19{digits(2)}"], [f"20{digits(2)}-0{digits(1)}-1{digits(1)}"],
            [f"{digits(2)}.{digits(2)}"], [digits(int(rng.integers(1, 4)))],
            ["token", "=", '"' + "".join(rng.choice(list("0123456789abcdef"), 40)) + '"'],
            [f"{digits(1)}.{digits(1)}.{digits(1)}"], [f"{word()}{digits(2)}", digits(2)],
        ][kind]

    table = []
    for _ in range(n):
        words: list[str] = []
        labels: list[int] = []
        for _ in range(int(rng.integers(1, 4))):
            words += (plain := [word() for _ in range(int(rng.integers(0, 5)))])
            labels += [0] * len(plain)
            pick_ = rng.integers(0, 7)
            unit = [email, ip, card, phone, harmless, harmless, harmless][pick_]()
            label = pick_ + 1 if pick_ < 4 else 0
            if rng.random() < 0.4:
                unit = [*unit[:-1], unit[-1] + str(rng.choice([",", ".", "!!", "%%%", "$$$", "###"]))]
            words += unit
            labels += [label] * len(unit)
            tail = word()
            words.append(tail)
            labels.append(0)
        table.append((words, labels))
    return table


def fit(
    table: Sequence[tuple[list[str], list[int]]], epochs: int = 100, rate: float = 0.4, l2: float = 1e-4
) -> Field:
    """Maximum conditional likelihood by forward-backward sums over all sequences at once.

    The sequences are padded to the longest one, so the table must be small, as agreed.
    """
    k, n, width = len(LABELS), len(table), max(len(w) for w, _ in table)
    x = np.zeros((n, width, N_SHAPES), np.float64)
    y = np.zeros((n, width), np.int64)
    mask = np.zeros((n, width), bool)
    for i, (words, labels) in enumerate(table):
        points, starts = code_points([w + " " for w in words])
        x[i, : len(words)] = shapes(points, starts[:-1], starts[1:] - 1)
        y[i, : len(words)], mask[i, : len(words)] = labels, True
    prev, following = np.zeros_like(x), np.zeros_like(x)
    prev[:, 1:], following[:, :-1] = x[:, :-1], x[:, 1:]
    parts = [np.zeros((N_SHAPES, k)) for _ in range(3)] + [np.zeros((k, k)), np.zeros(k)]
    seen = [np.full(p.shape, 1e-8) for p in parts]
    gold = np.eye(k)[y] * mask[..., None]
    both = mask[:, 1:] & mask[:, :-1]
    gold_pairs = np.einsum("nti,ntj,nt->ij", gold[:, :-1], gold[:, 1:], both.astype(float))
    for _ in range(epochs):
        e = x @ parts[0] + prev @ parts[1] + following @ parts[2]
        e[:, 0] += parts[4]
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, width):
            step = np.logaddexp.reduce(alpha[:, t - 1, :, None] + parts[3], axis=1) + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
        for t in range(width - 2, -1, -1):
            step = np.logaddexp.reduce(parts[3] + (e[:, t + 1] + beta[:, t + 1])[:, None], axis=2)
            beta[:, t] = np.where(mask[:, t + 1, None], step, 0)
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)
        marginal = np.exp(alpha + beta - total[:, None, None]) * mask[..., None]
        pair = alpha[:, :-1, :, None] + parts[3] + (e[:, 1:] + beta[:, 1:])[:, :, None]
        pair = np.exp(pair - total[:, None, None, None]) * both[..., None, None]
        error = marginal - gold
        gradients = [
            np.einsum("ntf,ntk->fk", f, error) / n + l2 * p
            for f, p in zip((x, prev, following), parts)
        ]
        gradients.append((pair.sum(axis=(0, 1)) - gold_pairs) / n + l2 * parts[3])
        gradients.append(error[:, 0].sum(axis=0) / n + l2 * parts[4])
        for p, g, s in zip(parts, gradients, seen):
            s += g * g
            p -= rate * g / np.sqrt(s)
    return Field(*(p.astype(np.float32) for p in parts), _plain_is_none(*parts))


def _plain_is_none(own, before, after, pairs, first) -> bool:
    """Whether plain words get no label in a sequence of plain words only.

    Holds if, for all shapes that plain words can have, naming nothing scores better than any
    run of labels, whatever its length: each word of the run loses more than it can gain from
    the label pairs and from the place at a sequence's begin.
    """
    free = [20, 21, 22, 23]  # columns that a plain word can set, beside 0 and 1
    fixed = own[0] + own[1]

    def most(w: np.ndarray, k: int) -> float:
        return np.maximum(0, w[free, k] - w[free, 0]).sum()

    for k in range(1, len(LABELS)):
        gain = fixed[k] - fixed[0] + most(own, k) + max(0, first[k] - first[0])
        for w in (before, after):
            gain += max(0, w[0, k] + w[1, k] - w[0, 0] - w[1, 0] + most(w, k))
        # A run of labels: its first word pays both its ends, each further one a pair inside.
        ends = max(0, pairs[0, k] - pairs[0, 0]) + max(0, pairs[1:, 0].max() - pairs[0, 0])
        inside = pairs[1:, k].max() - pairs[0, 0]
        if gain + max(ends, inside) >= 0:
            return False
    return True


# --- on tables ------------------------------------------------------------------------------


def find(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    result = []
    for text, more in zip(texts, field_spans(texts, field)):
        base = base_spans(text)
        result.append((base, sorted(base + apart_from(base, more))))
    return result


def apart_from(base: list[Span], more: list[Span]) -> list[Span]:
    """Those of more that overlap none of base; spans of base may overlap each other."""
    if not base or not more:
        return more
    ordered = sorted(base)
    starts = [s for s, _, _ in ordered]
    # How far the spans reach that begin at or before each one.
    reach = list(itertools.accumulate((e for _, _, e in ordered), max))
    return [a for a in more if not (i := bisect.bisect_left(starts, a[2])) or reach[i - 1] <= a[0]]


RESULT = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    "base_sha256 string, spans string, n_added bigint"
)


def find_personal(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """A row per row of docs: counts and digest of the base spans, all spans, n_added."""
    shared = docs.sparkSession.sparkContext.broadcast(field or fit(labelled_table()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text", CHUNK_CHARS):
            rows = []
            for base, spans in find(texts, shared.value):
                counts = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*counts, digest, written(spans), len(spans) - len(base)))
            names = [c.split()[0] for c in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c) for c in zip(*rows))], names=names
            )

    return pick(docs, "doc_id", "text").mapInArrow(run, RESULT)


def redact(text: str, spans: Sequence[Span]) -> str:
    """text with each span replaced by its kind in brackets; overlapping spans become one."""
    pieces, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            pieces += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*pieces, text[done:]])


def redacted(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """docs with the personal data in text replaced; other columns as they are, null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(field or fit(labelled_table()))
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")
    numbered = docs.toDF(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, names[at], CHUNK_CHARS):
            clean = [
                redact(t, spans) if spans else t
                for t, (_, spans) in zip(texts, find(texts, shared.value))
            ]
            old = batch.column(at)
            new = pc.if_else(old.is_null(), old, pa.array(clean, old.type))
            columns = [new if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)
