"""Phrase collocations by SON partitioning.

A shard is what one task reads, up to SHARD_WORDS words. Each shard is mined whole, with the support
lowered in proportion to its share of its language's words: a phrase that occurs MINIMUM times in
all does so at that rate in one shard at least. In a shard lengths are mined one after the other, as
a phrase is frequent only if what remains without its first or last word is. The union of what is
frequent in any shard are the candidates; all shards then count all candidates, and the sums are
exact. Words are counted first, then pairs are mined and counted, then all longer phrases, each round
among windows whose shorter parts are frequent in the whole corpus: with many shards the lowered
support is below one occurrence, and it is these rounds that bound what is counted.

Sets of phrases go to the tasks as bits of hashes in an array of BITS bits, whatever their number;
phrases that share a bit with a candidate are counted, too, and fall out by their sums. What is
returned is not counted by hash: in a shard windows are told apart by the numbers of their words,
over shards by their words.

The more shards, the lower their support, and the more is frequent in one of them only. So while a
shard is mined, all its windows of a round's least length are also summed by hash, in COUNTERS
numbers of fixed size. A candidate whose number stays below MINIMUM over all shards is not frequent
and is not counted. Bits and numbers leave a shard in blocks of BLOCK_BYTES, so many at most a shard
whatever it holds.

Only the best of a language are returned: the best of parts of its candidates first, then the best
of these, so that no task sorts all candidates of a language.

Cases: null texts are empty, null languages "und"; a text without words adds nothing; repeated rows
count as often as they are there; ties are ordered by phrase; an empty table gives no rows. Only
lang and text are read. A long text is read in parts, cut between pieces; a single piece of more
than CHUNK_CHARS is held whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import chunks, durable, mix, pick, run_hashes

# Fixed values of the contract.
BREAKS = ".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = "\x20\x09"
NO_LANG = "und"
MINIMUM = 100
LONGEST = 5
KEPT_PERCENT = 100
BEST = 2000

CHUNK_CHARS = 2_000_000
SHARD_WORDS = 6_000_000
BITS = 1 << 26
COUNTERS = 1 << 22
BLOCK_BYTES = 1 << 16
ROUNDS = ((2, 2), (3, LONGEST))

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS.encode())] = 1
_KIND[list(BREAKS.encode())] = 2


def tokenize(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """All words in order, in lower case, and the number of the piece that each is in."""
    data = "\n".join(texts).encode().translate(_LOWER)
    kind = _KIND[np.frombuffer(data, np.uint8)]
    edge = np.ones(len(kind) + 1, bool)
    np.not_equal(kind[1:] == 0, kind[:-1] == 0, out=edge[1:-1])
    edges = np.flatnonzero(edge) if len(kind) else np.zeros(1, np.int64)
    runs = pa.Array.from_buffers(
        pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data)]
    )
    first = edges[:-1]
    is_word = kind[first] == 0
    piece = np.cumsum(kind == 2)
    return runs.filter(pa.array(is_word)), piece[first[is_word]]


def parts_of(text: str, most: int = CHUNK_CHARS) -> list[str]:
    """The text in parts of about most characters, cut after a break."""
    parts, start = [], 0
    while len(text) - start > most:
        end = max(text.rfind(c, start, start + most) for c in BREAKS)
        if end < 0:
            later = [i for i in (text.find(c, start + most) for c in BREAKS) if i >= 0]
            if not later:
                break
            end = min(later)
        parts.append(text[start : end + 1])
        start = end + 1
    parts.append(text[start:] if start else text)
    return parts


class _Words:
    """The words of one language in a shard: a number each (0 between pieces)."""

    def __init__(self, total: int) -> None:
        self.total = total
        self.number: dict[bytes, int] = {}
        self.codes: list[np.ndarray] = []
        self.n = 0

    def add(self, texts: list[str]) -> None:
        words, piece = tokenize(texts)
        if not len(words):
            return
        coded = words.dictionary_encode()
        number = self.number
        own = np.array([number.setdefault(w, len(number) + 1) for w in coded.dictionary.to_pylist()], np.int64)
        new = np.append(True, piece[1:] != piece[:-1])
        codes = np.zeros(len(piece) + int(new.sum()), np.int32)
        codes[np.arange(len(piece)) + np.cumsum(new)] = own[coded.indices.to_numpy()]
        self.codes.append(codes)
        self.n += len(piece)

    def hashes(self, lang: str) -> np.ndarray:
        """A hash of language and word for each number."""
        words = [lang.encode(), *self.number]
        size = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(size)
        h = run_hashes(np.frombuffer(b"".join(words) + b"\0", np.uint8), (ends - size)[size > 0], ends[size > 0])
        return mix(h if size[0] else np.append(np.uint64(0), h)) + mix((h[:1] if size[0] else np.zeros(1, np.uint64)) + np.uint64(1))


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the distinct keys from 0 for all keys, a place of each, and how often it is there."""
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    sorted_ = keys[order]
    np.not_equal(sorted_[1:], sorted_[:-1], out=new[1:])
    del sorted_
    first = np.flatnonzero(new)
    numbers = np.empty(len(keys), np.int64)
    numbers[order] = np.cumsum(new) - 1
    return numbers, order[first], np.diff(np.append(first, len(keys)))


def _holds(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _all(length: int, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.ones(len(h), bool)


def phrases(
    words: _Words, lang: str, longest: int, keep
) -> Iterator[tuple[int, list[np.ndarray], np.ndarray, np.ndarray]]:
    """Length, numbers of the words, hash and count of the phrases of each length that
    keep(length, hash, count) says to keep; longer ones only where both parts were kept."""
    codes = np.concatenate([*words.codes, np.zeros(1, np.int32)])
    first = words.hashes(lang)
    at = np.flatnonzero(codes)
    numbers, places, counts = _numbered(codes[at].astype(np.int64))
    hashes = first[codes[at[places]]]
    for length in range(1, longest + 1):
        kept = keep(length, hashes, counts)
        spots = at[places[kept]]
        yield length, [codes[spots + i] for i in range(length)], hashes[kept], counts[kept]
        if length == longest or not len(spots):
            return
        # A window of one more word begins where a kept one begins and another begins next to it.
        good = kept[numbers]
        at, numbers = at[good], numbers[good]
        follows = np.flatnonzero(at[1:] == at[:-1] + 1)
        at, before = at[follows], numbers[follows]
        last = codes[at + length]
        hash_before = hashes
        numbers, places, counts = _numbered((before << 32) | last)
        hashes = mix(hash_before[before[places]] * np.uint64(0x9E3779B97F4A7C15) + first[last[places]])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, _Words]]:
    """Rows (lang, text, total) as shards: words by language."""
    shard: dict[str, _Words] = {}
    n = 0
    for batch, texts in chunks(batches, "text", CHUNK_CHARS):
        by_lang: dict[str, list[str]] = {}
        totals = dict(zip(langs := batch["lang"].to_pylist(), batch["total"].to_pylist()))
        for lang, text in zip(langs, texts):
            by_lang.setdefault(lang, []).append(text)
        del texts
        for lang, own in by_lang.items():
            words = shard.setdefault(lang, _Words(totals[lang]))
            before = words.n
            for part in parts_of(own[0]) if len(own) == 1 else [own]:
                words.add([part] if isinstance(part, str) else part)
            n += words.n - before
        if n >= SHARD_WORDS:
            yield shard
            shard, n = {}, 0
    if n:
        yield shard


COUNTS = "lang string, phrase string, length int, n bigint"
_COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("length", pa.int32()), ("n", pa.int64())])


def _rows(lang: str, words: _Words, found) -> Iterator[pa.RecordBatch]:
    names = pa.array([b"", *words.number], pa.binary()).cast(pa.string())
    for length, numbers, _, counts in found:
        for a in range(0, len(counts), 50_000):
            own = [names.take(pa.array(x[a : a + 50_000])) for x in numbers]
            text = pc.binary_join_element_wise(*own, " ") if length > 1 else own[0]
            k = len(text)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, k), text, pa.array(np.full(k, length, np.int32)), pa.array(counts[a : a + 50_000])],
                schema=_COUNTS,
            )


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, phrase (a word), length 1 and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            for lang, words in shard.items():
                yield from _rows(lang, words, phrases(words, lang, 1, _all))

    return _summed(texts.withColumn("total", F.lit(0).cast("bigint")).mapInArrow(run, COUNTS))


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("lang", "phrase", "length").agg(F.sum("n").alias("f"))


ARRAYS = "kind int, block int, data binary"
_ARRAYS = pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("data", pa.binary())])
HELD, SUMS = range(2)  # kinds: bits of a set, counts by hash


def _blocks(kind: int, array: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The blocks of an array that are not 0 throughout, a row each."""
    data = array.view(np.uint8)
    data = data.reshape(-1, min(BLOCK_BYTES, len(data)))
    used = np.flatnonzero(data.any(axis=1))
    for own in np.array_split(used, -(-len(used) // 16)) if len(used) else []:
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(kind, pa.int32()), len(own)), pa.array(own, pa.int32()),
             pa.array([data[i].tobytes() for i in own], pa.binary())],
            schema=_ARRAYS,
        )


def _set(bits: np.ndarray, h: np.ndarray) -> None:
    at = np.unique(h & np.uint64(len(bits) * 64 - 1))
    slot = (at >> np.uint64(6)).astype(np.int64)
    first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else slot
    if len(slot):
        bits[slot[first]] |= np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)


def _sum_of(h: np.ndarray) -> np.ndarray:
    """The part of the hash that says where its count goes."""
    return h >> np.uint64(38)


def _sums(bits: int) -> int:
    """How many counts there are beside so many bits."""
    return min(COUNTERS, bits)


def _together(blocks: DataFrame, bits: int, minimum: int) -> tuple[np.ndarray, np.ndarray]:
    """The bits set by any task, and the bits of the counts that come to minimum over all tasks:
    two arrays of fixed size at any size of the input, put together block by block."""
    kind = np.min_scalar_type(minimum)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for key, data in zip(zip(batch["kind"].to_pylist(), batch["block"].to_pylist()), batch["data"]):
                if key[0] == HELD:
                    new = np.frombuffer(data.as_buffer(), np.uint8)
                    found[key] = found[key] | new if key in found else new.copy()
                else:
                    new = np.frombuffer(data.as_buffer(), kind).astype(np.int64)
                    found[key] = found[key] + new if key in found else new
        for (what, block), x in found.items():
            x = x if what == HELD else np.packbits(x >= minimum, bitorder="little")
            yield pa.RecordBatch.from_arrays([pa.array([y], t) for y, t in zip((what, block, x.tobytes()), _ARRAYS.types)], schema=_ARRAYS)

    held, enough = np.zeros(bits // 8, np.uint8), np.zeros(max(8, _sums(bits) // 8), np.uint8)
    for row in blocks.repartition("kind", "block").mapInArrow(run, ARRAYS).toArrow().to_batches():
        for what, block, data in zip(*(c.to_pylist() for c in row.columns)):
            out = held if what == HELD else enough
            out[block * len(data) : (block + 1) * len(data)] = np.frombuffer(data, np.uint8)
    return held.view(np.uint64), enough.view(np.uint64)


def _gathered(blocks: DataFrame, bits: int) -> np.ndarray:
    return _together(blocks, bits, MINIMUM)[0]


def _known(table: DataFrame, bits: int) -> np.ndarray:
    """The bits of phrases (lang, phrase)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            by_lang: dict[str, list[list[str]]] = {}
            for lang, phrase in zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist()):
                by_lang.setdefault(lang, []).append(phrase)
            for lang, own in by_lang.items():
                words = _Words(0)
                words.add(own)
                for _, _, h, _ in phrases(words, lang, LONGEST, _all):
                    _set(held, h)
        yield from _blocks(HELD, held)

    return _gathered(table.select("lang", "phrase").mapInArrow(run, ARRAYS), bits)


def _mined(texts: DataFrame, known, first: int, last: int, minimum: int, bits: int) -> DataFrame:
    """The bits of what is frequent in a shard, at its share of the support, and by hash how often
    the shard has windows of first words, minimum at most (the rest does not matter)."""
    kind = np.min_scalar_type(minimum)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            held, sums = np.zeros(bits // 64, np.uint64), np.zeros(_sums(bits), np.int32)
            for lang, words in shard.items():
                support = -(-minimum * words.n // words.total)

                def keep(length: int, h: np.ndarray, n: np.ndarray) -> np.ndarray:
                    # All windows of first words are summed, so their parts need not be frequent here.
                    if length < first:
                        return _holds(known.value, h)
                    if length == first:
                        at, n_ = (_sum_of(h) & np.uint64(len(sums) - 1)).astype(np.int64), np.minimum(n, minimum)
                        order = np.argsort(at)
                        at = at[order]
                        new = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else at
                        if len(at):
                            own = np.minimum(sums[at[new]] + np.add.reduceat(n_[order], new), minimum)
                            sums[at[new]] = own
                    return n >= support

                for length, _, h, _ in phrases(words, lang, last, keep):
                    if length >= first:
                        _set(held, h)
            yield from _blocks(HELD, held)
            yield from _blocks(SUMS, sums.astype(kind))

    return texts.mapInArrow(run, ARRAYS)


def _counted(texts: DataFrame, known, candidates, first: int, last: int) -> DataFrame:
    """How often each candidate (and what shares a bit with one) occurs in each shard.

    candidates are two arrays of bits: what is frequent in some shard and, for windows of first
    words, what may come to the minimum in all shards together. Longer ones contain these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            for lang, words in shard.items():

                def keep(length: int, h: np.ndarray, n: np.ndarray) -> np.ndarray:
                    if length < first:
                        return _holds(known.value, h)
                    held, enough = candidates.value
                    found = _holds(held, h)
                    return found & _holds(enough, _sum_of(h)) if length == first else found

                found = phrases(words, lang, last, keep)
                yield from _rows(lang, words, (x for x in found if x[0] >= first))

    return texts.mapInArrow(run, COUNTS)


def frequent(
    docs: DataFrame, minimum: int = MINIMUM, longest: int = LONGEST, bits: int = BITS
) -> tuple[DataFrame, DataFrame]:
    """Two written tables: lang, phrase, length and f of all phrases of up to longest words that
    occur minimum times at least, and lang and n, the words of each language.

    bits is a power of two.
    """
    spark = docs.sparkSession
    texts = pick(docs, "lang", "text").select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    counts = durable(word_counts(texts))
    totals = durable(counts.groupBy("lang").agg(F.sum("f").alias("n")))
    found = durable(counts.where(F.col("f") >= minimum))
    # Texts of languages without words have none, so an inner join loses nothing.
    texts = texts.join(totals.select(F.col("lang").alias("_lang"), F.col("n").alias("total")), F.col("lang") == F.col("_lang"))
    texts = texts.select("lang", "text", "total")
    for first, last in ROUNDS:
        if first > longest:
            break
        last = min(last, longest)
        known = spark.sparkContext.broadcast(_known(found, bits))
        candidates = spark.sparkContext.broadcast(
            _together(_mined(texts, known, first, last, minimum, bits), bits, minimum)
        )
        sums = _summed(_counted(texts, known, candidates, first, last))
        found = found.unionByName(durable(sums.where(F.col("f") >= minimum)))
    return found, totals


def _words_of_phrase(first: Column, last: Column) -> Column:
    """Words first to last (from 1) of the phrase."""
    return F.array_join(F.slice(F.col("words"), first, last - first + 1), " ")


def scored(found: DataFrame, totals: DataFrame, longest: int = LONGEST, kept_percent: int = KEPT_PERCENT) -> DataFrame:
    """lang, phrase, a, l, r, n and score of the phrases of two words and more that are in no
    longer one as often (kept_percent of their own occurrences)."""
    long = found.where("length > 1").withColumn("words", F.split("phrase", " "))
    one = found.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias("_f"))

    cuts = long.select(
        "lang", "phrase", "length", F.col("f").alias("a"), "words",
        F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k",
        _words_of_phrase(F.lit(1), F.col("k")).alias("left"),
        _words_of_phrase(F.col("k") + 1, F.col("length")).alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(one, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_phrase"))).select(
            *[c for c in cuts.columns if c != side], F.col("_f").alias(name)
        )
    cuts = cuts.join(totals.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang")).drop("_lang")

    def wide(c: str, digits: int) -> str:
        return f"CAST({c} AS DECIMAL({digits},0))"

    # Exact: a and n take up to 17 digits each.
    score = F.expr(f"(CAST(1000 AS DECIMAL(4,0)) * {wide('a', 16)} * {wide('n', 16)}) div ({wide('l', 17)} * {wide('r', 17)})")
    cuts = cuts.withColumn("score", score)
    best = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b")
    ).select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")

    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("length") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("length") - size + 1),
                lambda first: F.array_join(F.slice(F.col("words"), first, size), " "),
            ),
        )
    )
    inside = (
        long.where("length > 2")
        .select(F.col("lang").alias("_lang"), "f", F.explode(F.array_distinct(spans)).alias("_phrase"))
        .groupBy("_lang", "_phrase")
        .agg(F.max("f").alias("_most"))
    )
    return (
        best.join(inside, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left")
        .where(F.col("_most").isNull() | (100 * F.col("_most") < kept_percent * F.col("a")))
        .drop("_lang", "_phrase", "_most")
    )


def best_of(rows: DataFrame, best: int = BEST) -> DataFrame:
    """rows of the best per lang, with their rank: score, then a, descending, then phrase."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(*order)
    some = rows.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= best).drop("rank")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.where(F.col("rank") <= best)


def collocations(
    docs: DataFrame, minimum: int = MINIMUM, longest: int = LONGEST,
    kept_percent: int = KEPT_PERCENT, best: int = BEST, bits: int = BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases."""
    found, totals = frequent(docs, minimum, longest, bits)
    return best_of(scored(found, totals, longest, kept_percent), best).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def _sql() -> str:
    words = [f"w{i}" for i in range(1, 6)]
    lengths = " UNION ALL ".join(
        f"SELECT lang, {' || chr(32) || '.join(words[:k])} AS phrase, {k} AS length, count(*) AS f "
        f"FROM windows WHERE w{k} IS NOT NULL GROUP BY ALL HAVING count(*) >= 100"
        for k in range(1, 6)
    )
    return rf"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(p, '[^\x20\x09]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
        FROM documents)
), ws AS (
  SELECT lang, piece, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM pieces
), windows AS (
  SELECT lang, w1, {', '.join(f'lead(w1, {k - 1}) OVER p AS w{k}' for k in range(2, 6))}
  FROM ws WINDOW p AS (PARTITION BY piece ORDER BY i)
), totals AS (
  SELECT lang, count(*) AS n FROM ws GROUP BY lang
), found AS ({lengths}
), cuts AS (
  SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, length)) AS k FROM found WHERE length > 1
), scores AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
         (1000 * CAST(c.a AS HUGEINT) * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts c JOIN found x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN found y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), subs AS (
  SELECT lang, f, string_split(phrase, ' ') AS w, length, unnest(range(2, length)) AS size FROM found WHERE length > 2
), inside AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(f) AS most
  FROM (SELECT *, unnest(range(1, length - size + 2)) AS i FROM subs) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       CAST(score AS BIGINT) AS score
FROM best b LEFT JOIN inside USING (lang, phrase)
WHERE most IS NULL OR 100 * most < 100 * a
QUALIFY rank <= 2000
"""


PHRASES_SQL = _sql()
