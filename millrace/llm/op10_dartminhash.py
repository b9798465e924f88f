"""Near-duplicates by DartMinHash signatures, banded joining and an exact check.

A text's words are its runs of letters and digits in lower case; its elements are its shingles
of five words (a shorter text is one shingle), weighted by how often each occurs. Two texts are
linked if their weighted Jaccard similarity is SIMILARITY or more; classes are what links and
equal texts connect.

Signature: every unit of an element's weight is a region into which darts fall at hashed times,
the same in every text. A text keeps the darts of its regions up to a time that lets about
DARTS_A_PLACE darts fall on each of the signature's places, and of these the earliest for each
place; where a place is still empty the time is doubled. The work is one dart per unit and some
hundreds more, however long the text, and two texts agree at a place with a probability equal
to their similarity.

Candidates: equal bands of ROWS places make a bucket, and a pair at 0.8 misses all BANDS with
probability 2e-5. No bucket is expanded into pairs. First all members meet the bucket's pivot, the
member that meets most others, so that a group of copies costs a pair a copy. Where the links
found do not make the bucket one class, those outside its largest class meet the members of other
classes whose fingerprints, two bits of each place, do not differ too much; pairs inside a class
are never needed. Every candidate is checked on the elements themselves. No bucket or partner is
capped.

Shuffles carry 64-bit numbers. Texts move once, and only those in a bucket with others move on.
Intermediate tables are written to the shared folder. The driver only sees counts.

Cases: a null text counts as empty; texts without any letter or digit are only linked to equal
texts; equal texts are one class whatever their ids; repeated rows each get their row; a class
whose ids are all null has class_id null; an empty table gives no rows. Only doc_id and text are
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (
    chunks,
    code_points,
    durable,
    mix,
    pick,
    run_hashes,
    spans_of,
    word_tables,
)

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 28, 5
# Signature places; the bands use the first BANDS * ROWS of them, fingerprints use all.
PLACES = 600
DARTS_A_PLACE = 9.0
# A fingerprint holds two bits of each place. A pair at 0.8 differs at 90 places in the mean, with
# a deviation of 8.7, and so at more than MOST_DIFFERENT with probability 4e-5.
PRINT_LONGS = -(-PLACES * 2 // 64)
MOST_DIFFERENT = 125
# Darts are thrown in blocks of about so many, whose arrays fit the processor's cache.
BLOCK_DARTS = 16_384
# Pairs are checked in blocks of about so many.
BLOCK_PAIRS = 20_000
CHUNK_CHARS = 500_000

_STEP = 0x9E3779B97F4A7C15  # the increment of splitmix64
_FOLD = np.array([(_STEP * (2 * i + 1)) % 2**64 for i in range(SHINGLE)], np.uint64)
_EMPTY = np.uint64(2**64 - 1)


def elements(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed units of weight, and the text of each, in the order of the texts.

    The second, third... time that a shingle occurs in a text is a unit of its own.
    """
    points, starts = code_points(texts)
    word, lower = word_tables()
    points = lower[points]
    first, end = spans_of(word[points], starts)
    h = run_hashes(points, first, end)
    owner = np.searchsorted(starts, first, side="right") - 1
    count = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), int)
    hashed, owners = [], []
    if len(h) >= SHINGLE:
        n = len(h) - SHINGLE + 1
        s = np.zeros(n, np.uint64)
        for i in range(SHINGLE):
            s += h[i : n + i] * _FOLD[i]
        within = owner[:n] == owner[SHINGLE - 1 :]
        hashed.append(mix(s[within]))
        owners.append(owner[:n][within])
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        begin = np.searchsorted(owner, short)
        s = count[short].astype(np.uint64)
        for i in range(SHINGLE - 1):
            has = count[short] > i
            s[has] += h[begin[has] + i] * _FOLD[i]
        hashed.append(mix(s))
        owners.append(short)
    if not hashed:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    s, o = np.concatenate(hashed), np.concatenate(owners)
    order = np.lexsort((s, o))
    s, o = s[order], o[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1])
    runs = np.flatnonzero(new)
    again = np.arange(len(s)) - np.repeat(runs, np.diff(np.append(runs, len(s))))
    return np.where(again > 0, mix(s + again.astype(np.uint64) * np.uint64(_STEP)), s), o


def _throw(
    sig: np.ndarray, seed: np.ndarray, of: np.ndarray, time: np.ndarray, until: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Puts the next k darts of each unit into sig, of those that come before their text's until.

    Gives each unit's seed and time at the last of these, and whether all k came before it.
    """
    g = mix(seed + np.arange(1, k + 1, dtype=np.uint64)[:, None] * np.uint64(_STEP))
    times = -np.log(((g >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
    times[0] += time
    # One after the other, so that a dart's time is the same however many are thrown at once.
    np.cumsum(times, axis=0, out=times)
    hit = times < until[of]
    hits = np.count_nonzero(hit, axis=0)
    at = np.flatnonzero(hit)
    name = mix(g.ravel()[at] ^ np.uint64(_STEP))
    # The remainder by PLACES; the operator % takes several times as long.
    place = (name - name // np.uint64(PLACES) * np.uint64(PLACES)).astype(np.int64)
    place += of[at % len(of)] * PLACES
    early = times.ravel()[at].astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)
    np.minimum.at(sig, place, early | (name >> np.uint64(32)))
    last = times[hits - 1, np.arange(len(of))]
    seed = seed + hits.astype(np.uint64) * np.uint64(_STEP)
    return seed, np.where(hits > 0, last, time), hits == k


def signatures(units: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """PLACES numbers a text: time (as float32) and name of each place's earliest dart.

    Units go in blocks of BLOCK_DARTS darts. About as many are thrown at once as a unit is likely
    to have, so units that have alike many are taken together: those of texts of alike weight.
    """
    sig = np.full(n * PLACES, _EMPTY)
    weight = np.bincount(owner, minlength=n)
    order = np.argsort(weight[owner], kind="stable")
    seed, of = units[order], owner[order]
    time = np.zeros(len(seed))
    until = np.zeros(n)
    until[weight > 0] = PLACES * DARTS_A_PLACE / weight[weight > 0]
    open_ = weight > 0
    left, likely = np.arange(len(seed)), until
    while open_.any():
        i, more = 0, []
        while i < len(left):
            k = int(likely[of[left[i]]]) + 1
            own = left[i : i + max(1, BLOCK_DARTS // k)]
            own = own[: np.count_nonzero(2 * likely[of[own]] + 2 >= k)]
            seed[own], time[own], all_hit = _throw(sig, seed[own], of[own], time[own], until, k)
            more.append(own[all_hit])
            i += len(own)
        # The number of a unit's darts varies by about the root of the number likely.
        left, likely = np.concatenate(more), np.sqrt(until)
        if not len(left):
            open_ &= (sig.reshape(n, PLACES) == _EMPTY).any(axis=1)
            likely = until.copy()
            until[open_] *= 2
            left = np.flatnonzero(open_[of])
    return sig.reshape(n, PLACES)


def bands(sig: np.ndarray) -> np.ndarray:
    """BANDS bucket keys a text."""
    parts = sig[:, : BANDS * ROWS].reshape(len(sig), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for i in range(ROWS):
        key = mix(key * np.uint64(_STEP) + parts[:, :, i])
    return key.view(np.int64)


def fingerprints(sig: np.ndarray) -> np.ndarray:
    """PRINT_LONGS numbers a text, with two bits of each place's dart."""
    bits = np.zeros((len(sig), PRINT_LONGS * 32), np.uint64)
    bits[:, :PLACES] = sig & np.uint64(3)
    shift = np.arange(32, dtype=np.uint64) * np.uint64(2)
    packed = (bits.reshape(len(sig), PRINT_LONGS, 32) << shift).sum(axis=2, dtype=np.uint64)
    return packed.view(np.int64)


def differing(a: str, b: str) -> Column:
    """At how many places the fingerprints in columns a0, a1... and b0, b1... differ."""
    total = F.lit(0)
    for i in range(PRINT_LONGS):
        x = F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))
        either = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        total = total + F.bit_count(either)
    return total


def print_columns(of: str, name: str) -> list[Column]:
    return [F.get(of, F.lit(i)).alias(f"{name}{i}") for i in range(PRINT_LONGS)]


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, weight and bucket keys of each row: the pass over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text", CHUNK_CHARS):
            units, owner = elements(texts)
            weight = np.bincount(owner, minlength=len(texts))
            some = np.flatnonzero(weight)
            dense = np.searchsorted(some, owner)
            sig = signatures(units, dense, len(some))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["digest"], pa.array(weight, pa.int64()),
                 _lists(bands(sig).ravel(), np.where(weight > 0, BANDS, 0)),
                 _lists(fingerprints(sig).ravel(), np.where(weight > 0, PRINT_LONGS, 0))],
                names=["doc_id", "digest", "weight", "keys", "print"],
            )

    rows = pick(docs, "doc_id", "text").select("doc_id", digest_of(F.col("text")).alias("digest"), "text")
    return rows.mapInArrow(
        run, "doc_id bigint, digest binary, weight bigint, keys array<bigint>, print array<bigint>"
    )


def _with_elements(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and units, in order, of the texts named in wanted (node, digest, first_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text", CHUNK_CHARS):
            units, owner = elements(texts)
            counts = np.bincount(owner, minlength=len(texts))
            units = units.view(np.int64)
            units = units[np.lexsort((units, owner))]
            yield pa.RecordBatch.from_arrays(
                [batch["node"], _lists(units, counts)], names=["node", "units"]
            )

    rows = pick(docs, "doc_id", "text").withColumn("_digest", digest_of(F.col("text")))
    # Of equal texts only the row with the least id matches, and of repeated rows one is taken.
    found = rows.join(
        wanted,
        (F.col("_digest") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("first_id")),
    )
    one = found.groupBy("node").agg(F.first("text").alias("text"))
    return one.mapInArrow(run, "node bigint, units array<bigint>")


def _similar(pairs: DataFrame, units: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose similarity is least or more, with it.

    Pairs are dealt into a grid of blocks by both their texts, so fine that neither all pairs nor
    those of one text fill a block; a text's elements go once to each block that needs them.
    """
    degree = F.count("*").alias("n")
    n, most_a = pairs.groupBy("a").agg(degree).agg(F.sum("n"), F.max("n")).first()
    (most_b,) = pairs.groupBy("b").agg(degree).agg(F.max("n")).first()
    even = math.sqrt((n or 0) / BLOCK_PAIRS)
    down, across = (max(1, math.ceil(max(even, (m or 0) / BLOCK_PAIRS))) for m in (most_b, most_a))
    row, column = F.pmod(F.xxhash64("a"), down), F.pmod(F.xxhash64("b"), across)
    dealt = pairs.select("a", "b", (row * across + column).alias("block"))
    needed = dealt.select("block", F.explode(F.array("a", "b")).alias("node")).distinct()
    contents = needed.join(units, "node").select(F.col("block").alias("of"), "node", "units")

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        nodes = right["node"].to_numpy()
        order = np.argsort(nodes)
        lists = right["units"].combine_chunks()
        values = lists.flatten().to_numpy()
        starts = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        a, b = (
            order[np.searchsorted(nodes, left[c].to_numpy(), sorter=order)] for c in ("a", "b")
        )
        by_a = np.argsort(a, kind="stable")
        a, b = a[by_a], b[by_a]
        alike = np.zeros(len(a))
        for k in range(len(a)):
            own = values[starts[a[k]] : starts[a[k] + 1]]
            other = values[starts[b[k]] : starts[b[k] + 1]]
            if min(len(own), len(other)) >= least * max(len(own), len(other)):
                at = np.searchsorted(own, other)
                at[at == len(own)] = 0
                both = np.count_nonzero(own[at] == other)
                alike[k] = both / (len(own) + len(other) - both)
        good = alike >= least
        return pa.table({"a": nodes[a[good]], "b": nodes[b[good]], "similarity": alike[good]})

    return dealt.groupBy("block").cogroup(contents.groupBy("of")).applyInArrow(
        check, "a bigint, b bigint, similarity double"
    )


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """labels (node, label) with labels joined by edges (a, b) made one, the least of them.

    Each round every label moves to its least neighbour, and on to where that one moves until
    none moves any more; edges then connect what is left, at most half as many labels.
    """
    names = labels.select("node", "label")
    while True:
        # Edges between labels: first from nodes, later from the labels of the round before.
        one = names.select(F.col("node").alias("a"), F.col("label").alias("la"))
        other = names.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        edges = durable(
            edges.join(one, "a", "left")
            .join(other, "b", "left")
            .select(F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb"))
            .where("la <> lb")
            .select(*_ordered(F.col("la"), F.col("lb")))
            .distinct()
        )
        if edges.isEmpty():
            return labels
        moves = durable(edges.groupBy(F.col("b").alias("label")).agg(F.min("a").alias("to")))
        while True:
            onward = moves.select(F.col("label").alias("to"), F.col("to").alias("further"))
            jumped = durable(
                moves.join(onward, "to", "left").select("label", "to", "further")
            )
            if jumped.where("further IS NOT NULL").isEmpty():
                break
            moves = jumped.select("label", F.coalesce("further", "to").alias("to"))
        labels = durable(
            labels.join(moves, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        )
        names = moves.select(F.col("label").alias("node"), F.col("to").alias("label"))


def _between_classes(
    open_: DataFrame, nodes: DataFrame, pivots: DataFrame, measured: DataFrame
) -> DataFrame:
    """The pairs (a, b) still to be checked: members of one bucket in different classes, at least
    one of them outside the bucket's largest class, not measured yet.

    A pair is left out if it cannot reach SIMILARITY by its weights, or by its distances to the
    bucket's pivot (1 - similarity is a metric, so they may differ by 1 - SIMILARITY at most), or
    will hardly do by its fingerprints. It comes from the first bucket that both are in.
    """
    sizes = open_.groupBy("key", "label").count()
    largest = sizes.groupBy("key").agg(F.max(F.struct("count", "label"))["label"].alias("main"))
    known = measured.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("node"), F.col("b").alias("pivot"), "similarity"),
                F.struct(F.col("b").alias("node"), F.col("a").alias("pivot"), "similarity"),
            )
        ).alias("m")
    ).select("m.*").distinct()
    near_pivot = F.when(F.col("node") == F.col("pivot"), 1.0).otherwise(F.col("similarity"))
    prints = [f"p{i}" for i in range(PRINT_LONGS)]
    full = durable(
        open_.join(largest, "key")
        .join(pivots, "key")
        .join(known, ["node", "pivot"], "left")
        .withColumn("near", near_pivot)
        .join(nodes.select("node", "keys", *print_columns("print", "p")), "node")
        .select("key", "band", "node", "weight", "label", "main", "near", "keys", *prints)
    )
    x = full.where("label <> main").select(
        "key", F.col("node").alias("x"), F.col("label").alias("lx"), F.col("weight").alias("wx"),
        F.col("near").alias("nx"), F.col("keys").alias("kx"),
        *[F.col(p).alias(f"x{p[1:]}") for p in prints],
    )
    earlier = F.arrays_overlap(
        F.slice("keys", F.lit(1), F.col("band")), F.slice("kx", F.lit(1), F.col("band"))
    )
    return (
        x.join(full, "key")
        .where(F.col("label") != F.col("lx"))
        .where((F.col("label") == F.col("main")) | (F.col("x") < F.col("node")))
        .where(F.least("weight", "wx") >= SIMILARITY * F.greatest("weight", "wx"))
        .where(F.abs(F.col("near") - F.col("nx")) <= 1 - SIMILARITY + 1e-9)
        .where(differing("p", "x") <= MOST_DIFFERENT)
        .where(~earlier)
        .select(*_ordered(F.col("x"), F.col("node")))
        .distinct()
        .join(measured, ["a", "b"], "left_anti")
    )


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the rows: doc_id, digest. Of the distinct texts: digest, first_id (least id), class_id
    and whether the text is its class's first."""
    rows = durable(sketches(docs))
    nodes = durable(
        rows.groupBy("digest")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.first("weight").alias("weight"),
            F.first("keys").alias("keys"),
            F.first("print").alias("print"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    placed = nodes.select("node", "weight", F.posexplode("keys").alias("band", "key"))
    shared = placed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = durable(placed.join(shared, "key"))
    inside = members.select("node").distinct()
    wanted = nodes.select("node", "digest", "first_id").join(inside, "node", "left_semi")
    units = durable(_with_elements(docs, wanted))

    # The text that meets most others is in the middle of a group of copies: as a pivot it links
    # to copies that need not be near each other.
    met = members.groupBy("node").agg(F.sum("n").alias("met"))
    pivots = durable(
        members.join(met, "node")
        .groupBy("key")
        .agg(F.max(F.struct("met", "node"))["node"].alias("pivot"))
    )
    tried = durable(
        members.join(pivots, "key")
        .where("node <> pivot")
        .select(*_ordered(F.col("node"), F.col("pivot")))
        .distinct()
    )
    measured = durable(_similar(tried, units, 0.0))
    alone = durable(inside.select("node", F.col("node").alias("label")))
    labels = components(alone, measured.where(F.col("similarity") >= SIMILARITY).select("a", "b"))

    placed_labels = members.select("key", "band", "node", "weight").join(labels, "node")
    mixed = (
        placed_labels.groupBy("key")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where("lo <> hi")
        .select("key")
    )
    open_ = durable(placed_labels.join(mixed, "key"))
    if not open_.isEmpty():
        rest = durable(_between_classes(open_, nodes, pivots, measured))
        more = durable(_similar(rest, units, SIMILARITY).select("a", "b"))
        labels = components(labels, more)

    known = nodes.select("digest", "first_id", "node").join(labels, "node", "left").select(
        "digest", "first_id", "node", F.coalesce("label", "node").alias("label")
    )
    known = durable(known)
    first = known.groupBy("label").agg(
        F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "node")).alias("f")
    )
    texts = known.join(first, "label").select(
        "digest", "first_id", F.col("f.first_id").alias("class_id"),
        (F.col("f.node") == F.col("node")).alias("is_first"),
    )
    return rows.select("doc_id", "digest"), durable(texts)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row per row of docs: doc_id, class_id (the least id of its class) and copy_of (the least
    id among equal texts)."""
    rows, texts = classes(docs)
    return rows.join(texts, "digest", "left").select(
        "doc_id", "class_id", F.col("first_id").alias("copy_of")
    )


def one_of_each_class(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, of which one of each class stays: that with the least id."""
    _, texts = classes(docs)
    names = docs.columns
    numbered = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    at = {c: f"_c{i}" for i, c in reversed(list(enumerate(names)))}
    keep = texts.where("is_first").select("digest", "first_id")
    found = numbered.withColumn("_digest", digest_of(F.col(at["text"]))).join(
        keep, (F.col("_digest") == F.col("digest")) & F.col(at["doc_id"]).eqNullSafe(F.col("first_id"))
    )
    # Repeated rows are equal in text and id.
    return found.dropDuplicates(["_digest", at["doc_id"]]).select(
        *[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)]
    )
