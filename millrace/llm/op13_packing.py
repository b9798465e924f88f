"""Packing token sequences hierarchically into windows of several lengths.

A document is its ids and END. As many whole windows of WINDOW ids as it has are sequences of their
own; what is left is routed to the tier (WINDOW, half of it, a quarter, ... LEAST) that it fills to
more than half. Each tier's windows are begun by its own documents, longest first. Their gaps are
filled from shorter tiers: a piece that fits best, or, where none fits, a longer one cut to the gap,
whose rest goes back. So windows of every tier are full and need no padding, being powers of two;
less than LEAST ids are left at the end, and they, too, are cut into powers of two. Sequences are
dealt out to step groups round robin, longest first, so that groups differ by one window at most
and each has its share of every tier.

How it is spread: documents that leave the same length are alike to the plan, so it is made of how
many there are of each length, below WINDOW numbers however many documents there are: the plan
says which ranks among the documents of a length go where. Ranks are counted by task, and summed
over tasks by length. Each document then finds its pieces by itself. Ids are written once, as
read by the tasks that encode; the plan, some thousand rows at any size, goes to all tasks.

Words are encoded once a task, not once an occurrence; long texts are cut where no word goes on.

Cases: a null or empty text is END alone; null ids and repeated rows are documents of their own; an
empty table gives no rows. Only doc_id and text are read. Names of special tokens in a text are
text.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import durable, pick
from millrace.llm.op06_bpe import CHUNK_CHARS, LETTER, NUMBER, OTHER, SPACE, gather, in_parts, words_of

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
# Fixed values of the contract.
WINDOW = 1024
END = 0

# The shortest tier that is packed; shorter windows are only made of what is left at the end.
LEAST = 64
# About how many ids a step group has.
STEP_TOKENS = 1 << 16
# A task keeps the ids of this many words.
KEPT_WORDS = 400_000


@functools.cache
def tokenizer(vocabulary: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary)
    t.encode_special_tokens = True
    return t


@functools.cache
def classes(vocabulary: str) -> np.ndarray:
    """What the tokenizer takes each code point for.

    Only code points that Python's Unicode does not know, but regex's does, are in doubt; the
    tokenizer itself is asked for these.
    """
    known = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    table = np.full(0x110000, OTHER, np.uint8)
    pre = tokenizer(vocabulary).pre_tokenizer
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for run in regex.findall(pattern, known):
            table[[ord(c) for c in run]] = kind
    for i in np.flatnonzero(table != OTHER).tolist():
        c = chr(i)
        if unicodedata.category(c) == "Cn":
            one = [kind for kind, x in ((LETTER, "a"), (NUMBER, "1")) if len(pre.pre_tokenize_str(x + c + x)) == 1]
            table[i] = one[0] if one else OTHER
    return table


@functools.cache
def encoding(vocabulary: str) -> tiktoken.Encoding:
    """The same byte-level BPE in the faster library: its ranks are the ids of the vocabulary.

    That holds if merges are listed in the order of the ids that they make, which is checked.
    """
    model = json.loads(tokenizer(vocabulary).to_str())["model"]
    # Bytes stand for themselves where they are printable, the others for code points from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if model["type"] != "BPE" or model["ignore_merges"] or made != sorted(made):
        raise ValueError(f"{vocabulary}: merges are not in the order of ids")
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items()}
    return tiktoken.Encoding("ids", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class _Ids:
    """Ids of texts; the ids of a word are looked up if it was met before."""

    def __init__(self, vocabulary: str) -> None:
        self.of, self.classes = encoding(vocabulary)._encode_single_piece, classes(vocabulary)
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        # The ids of all known words one after the other, and where those of each word begin.
        self.values, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where those of each text end."""
        words, n = words_of(texts, self.classes)
        coded = words.dictionary_encode()
        del words
        distinct = coded.dictionary.to_pylist()
        if len(self.number) + len(distinct) > KEPT_WORDS:
            self.forget()
        number = self.number
        new = [w for w in distinct if w not in number]
        if new:
            number.update(zip(new, range(len(number), len(number) + len(new))))
            lists = [self.of(w) for w in new]
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            added = np.fromiter(itertools.chain.from_iterable(lists), np.uint32, int(size.sum()))
            self.first = np.append(self.first, self.first[-1] + np.cumsum(size))
            self.values = np.append(self.values, added)
        own = np.array([number[w] for w in distinct], np.int64)
        if not len(own):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        size = np.diff(self.first)
        codes = own[coded.indices.to_numpy()]
        ids = gather(self.values, self.first, size, codes)
        return ids, np.append(0, np.cumsum(size[codes]))[np.cumsum(n)]


ENCODED = "doc_id bigint, task int, rest int, rank bigint, full bigint, tokens bigint, ids binary"


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW) -> DataFrame:
    """A row a document, written: its ids and END (little-endian, 2 bytes each if that is enough).

    rest is what whole windows leave; rank counts the documents of the task with that rest, full
    the whole windows of the task's documents, both before this one.
    """
    kind = np.dtype("<u2" if tokenizer(vocabulary).get_vocab_size() <= 1 << 16 else "<u4")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("task", pa.int32()), ("rest", pa.int32()), ("rank", pa.int64()),
         ("full", pa.int64()), ("tokens", pa.int64()), ("ids", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        to_ids = _Ids(vocabulary)
        ranks = np.zeros(window, np.int64)
        full = 0
        held: list[bytes] = []
        for rows, texts, part, parts, batch in in_parts(batches, CHUNK_CHARS):
            ids, ends = to_ids(texts)
            ids = ids.astype(kind)
            start, done = 0, []
            for row, end, i, k in zip(rows, ends.tolist(), part, parts):
                own = ids[start:end].tobytes()
                start = end
                if i < k - 1:
                    held.append(own)
                    continue
                if held:
                    own, held = b"".join([*held, own]), []
                own += END.to_bytes(kind.itemsize, "little")
                n = len(own) // kind.itemsize
                rest = n % window
                done.append((batch["doc_id"][row].as_py(), task, rest, int(ranks[rest]), full, n, own))
                ranks[rest] += 1
                full += n // window
            if done:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*done), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = pick(docs, "doc_id", "text").mapInArrow(run, ENCODED)
    return durable(rows)


class Plan:
    """Where pieces go, from how many documents leave how much.

    Pieces of one length wait in a line, and so do begun windows of one length that are filled
    alike. A move takes the first n pieces of a length and the first n windows of a kind, fills as
    much as fits and lets rests of pieces and windows join the ends of other lines. So moves are
    as many as kinds of windows meet lengths, and a piece's way is found from its place in line:
    from move to move until its ids are used, and on with each of its windows until that is full.
    """

    def __init__(self, counts: dict[int, int], window: int = WINDOW, least: int = LEAST) -> None:
        self.window = window
        head, tail = [0] * (window + 1), [0] * (window + 1)
        for rest, n in counts.items():
            if rest:
                tail[rest] = n
        total = sum(rest * n for rest, n in counts.items())
        pieces: dict[int, list[tuple]] = {}
        windows: dict[int, list[tuple]] = {}
        self.sizes: list[tuple[int, int]] = []
        self.sequences = 0
        size = window
        while size:
            # Of each kind of window of this size: how many were moved on, how many there were.
            gone, came = [0] * (size + 1), [0] * (size + 1)

            def move(length: int, filled: int, most: int) -> None:
                n = min(most, tail[length] - head[length])
                used = min(size - filled, length)
                rest, then = length - used, filled + used
                pieces.setdefault(length, []).append(
                    (head[length], self._kind(size, filled), gone[filled], filled, used, rest, tail[rest] if rest else 0)
                )
                windows.setdefault(self._kind(size, filled), []).append((gone[filled], self._kind(size, then), came[then]))
                head[length] += n
                gone[filled] += n
                came[then] += n
                if rest:
                    tail[rest] += n

            # What is routed to this tier begins windows, no more than all ids left can fill.
            room = total // size
            for length in range(window, size // 2 if size > least else 0, -1):
                while room and tail[length] > head[length]:
                    before = gone[0]
                    move(length, 0, room)
                    room -= gone[0] - before
            total -= gone[0] * size
            for filled in range(1, size):
                gap = size - filled
                while came[filled] > gone[filled]:
                    length = next((x for x in range(gap, 0, -1) if tail[x] > head[x]), 0)
                    length = length or next(x for x in range(gap, window + 1) if tail[x] > head[x])
                    move(length, filled, came[filled] - gone[filled])
            self.sizes.append((size, self.sequences))
            self.sequences += came[size]
            size //= 2
        self.piece_at, self.piece = self._table(pieces, 7)
        self.window_at, self.move = self._table(windows, 3)
        self.first = np.zeros(self._kind(window, window) + 1, np.int64)
        for size, first in self.sizes:
            self.first[self._kind(size, size)] = first

    def _kind(self, size: int, filled: int) -> int:
        return size.bit_length() * (self.window + 1) + filled

    @staticmethod
    def _table(lines: dict[int, list[tuple]], width: int) -> tuple[np.ndarray, np.ndarray]:
        rows = [((key << 48) + r[0], r) for key in sorted(lines) for r in lines[key]]
        return (
            np.array([k for k, _ in rows], np.int64),
            np.array([r for _, r in rows], np.int64).reshape(-1, width),
        )

    def pieces(self, rest: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """For documents that leave rest > 0 ids and have these ranks: arrays of document (its
        place in rest), start in what is left, length, sequence and offset, a member a piece."""
        doc = np.arange(len(rest))
        length, place, start = rest.astype(np.int64), rank.astype(np.int64), np.zeros(len(rest), np.int64)
        found = []
        while len(doc):
            at = np.searchsorted(self.piece_at, (length << 48) + place, side="right") - 1
            first, kind, line, offset, used, left, then = self.piece[at].T
            found.append((doc, start, used, kind, line + place - first, offset))
            more = left > 0
            doc, start, length = doc[more], (start + used)[more], left[more]
            place = (then + place - first)[more]
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(5))
        doc, start, used, kind, line, offset = map(np.concatenate, zip(*found))
        kind, line = kind.copy(), line.copy()
        todo = np.arange(len(kind))
        while len(todo):
            at = np.searchsorted(self.window_at, (kind[todo] << 48) + line[todo], side="right") - 1
            first, then, line_then = self.move[at].T
            line[todo] += line_then - first
            kind[todo] = then
            # Full windows are of the kind (size, size); no move begins there.
            bits, filled = np.divmod(then, self.window + 1)
            todo = todo[filled != 1 << (bits - 1)]
        return doc, start, used, self.first[kind] + line, offset


PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def pack(
    docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW, least: int = LEAST,
    step_tokens: int = STEP_TOKENS, with_ids: bool = True,
) -> DataFrame:
    """A row a piece: doc_id, start, length, ids (4 bytes each, little-endian; null without
    with_ids), ids_crc32, doc_tokens, sequence_id, offset, window (the sequence's length) and
    step_group.

    window and least are powers of two; 0 < least <= window < 65,536.
    """
    rows = encoded(docs, vocabulary, window)
    wide = tokenizer(vocabulary).get_vocab_size() > 1 << 16
    # One row a task and rest: how many documents and whole windows the tasks before have.
    by_task = rows.groupBy("task", "rest").agg(
        F.count("*").alias("n"), F.sum(F.floor(F.col("tokens") / window).cast("bigint")).alias("whole")
    )
    by_task = durable(by_task)
    totals = {r["rest"]: r for r in by_task.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    whole = by_task.groupBy("task").agg(F.sum("whole").alias("whole"))
    all_whole = whole.agg(F.sum("whole")).first()[0] or 0
    plan = Plan({k: r["n"] for k, r in totals.items()}, window, least)
    tokens = all_whole * window + sum(k * r["n"] for k, r in totals.items())
    groups = max(1, -(-tokens // step_tokens))

    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = by_task.select(
        F.col("task").alias("_task"),
        F.col("rest").alias("_rest"),
        F.coalesce(F.sum("n").over(Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_rank"),
    )
    offsets = whole.select(
        F.col("task").alias("_of"), F.coalesce(F.sum("whole").over(before), F.lit(0)).alias("_full")
    )
    known = durable(earlier.join(offsets, F.col("_task") == F.col("_of")).drop("_of"))
    placed = rows.join(known, (F.col("task") == F.col("_task")) & (F.col("rest") == F.col("_rest"))).select(
        "doc_id", "rest", (F.col("rank") + F.col("_rank")).alias("rank"),
        (F.col("full") + F.col("_full")).alias("full"), "tokens", "ids",
    )
    shared = docs.sparkSession.sparkContext.broadcast(plan)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
         ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
         ("offset", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 1000):
                yield from of(batch.slice(start, 1000))

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rest, rank, full, n = (batch[c].to_numpy() for c in ("rest", "rank", "full", "tokens"))
        own = np.flatnonzero(rest)
        doc, start, length, at, offset = shared.value.pieces(rest[own], rank[own])
        doc = own[doc]
        start = start + (n - rest)[doc]
        at = at + all_whole
        # Whole windows: one piece each.
        whole = n // window
        by = np.repeat(np.arange(len(n)), whole)
        nth = np.arange(len(by)) - np.repeat(np.cumsum(whole) - whole, whole)
        doc, start, at = np.append(by, doc), np.append(nth * window, start), np.append(full[by] + nth, at)
        length = np.append(np.full(len(by), window), length)
        offset = np.append(np.zeros(len(by), np.int64), offset)
        order = np.lexsort((start, doc))
        packed = batch["ids"]
        for a in range(0, len(order), 4000):
            part = order[a : a + 4000]
            last, crcs, kept = -1, [], []
            for i, s, k in zip(doc[part].tolist(), start[part].tolist(), length[part].tolist()):
                if i != last:
                    last, ids = i, np.frombuffer(packed[i].as_buffer(), "<u4" if wide else "<u2")
                data = ids[s : s + k].astype("<u4").tobytes()
                crcs.append(zlib.crc32(data))
                kept.append(data if with_ids else None)
            rows = doc[part]
            columns = [
                batch["doc_id"].take(pa.array(rows)), pa.array(start[part]), pa.array(length[part]),
                pa.array(kept, pa.binary()), pa.array(crcs, pa.int64()), pa.array(n[rows]),
                pa.array(at[part]), pa.array(offset[part]),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    pieces = placed.mapInArrow(run, PIECES)
    # The plan gives sequences in order of length, so the number of one says how long it is.
    at = F.col("sequence_id")
    length = F.lit(window)
    for size, first in plan.sizes:
        length = F.when(at >= all_whole + first, F.lit(size)).otherwise(length)
    return pieces.withColumn("window", length.cast("bigint")).withColumn("step_group", at % F.lit(groups))
