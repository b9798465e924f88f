"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Texts are cut into pre-tokens (the pattern's matches; "words" here). A block is what one task
reads until the words and numbers it holds come to BLOCK_BYTES. In a block every distinct word gets
a number, and a text becomes the list of its words' numbers in order: words exploded with
positions, the positions of a block packed together. The distinct words of all blocks are then
shuffled by word, so that each is encoded once, by its task, for all texts; its ids go back to the
blocks that hold it, those of a block packed together, and each text's ids are put together by position. Decoding looks the ids up in
the table of token bytes.

A text of more than PIECE_CHARS is cut where no match can go on (before white space, between
letters and digits); its parts are rows with a position, in whichever blocks they fall, and are put
together at the end. So memory holds a block, whatever words it has and however long a text is;
only a run without any such place (one word of millions of letters) is held whole.

A word that is in every text costs one row a block. Blocks are stored in a bucketed table in the
shared folder, so that the way back shuffles ids only, not texts. Its buckets are no more than the
session allows, and it leaves the catalog at once; its files stay like those of other tables.

Cases: a null or empty text has no ids; null ids and repeated rows each get their row; an empty
table gives no rows. Only doc_id and text are read. No special tokens.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import unicodedata
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import LAST_WORD_POINT, chunks, durable, pick, release, shared_dir

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CHUNK_CHARS = 2_000_000
# Texts are cut into words about so many characters at a time, and a longer text into such parts.
PIECE_CHARS = 250_000
# What a block's words and numbers take; a word costs about WORD_BYTES besides its own.
BLOCK_BYTES = 96 << 20
WORD_BYTES = 120
# Scans in smaller splits are joined to about so many bytes a task: larger blocks share more words.
SPLIT_BYTES = 48 << 20
# Words and ids that a task packs together on their way back to the blocks.
PACKED_ROWS = 1_000_000
# Ids below twice this are kept less this as 16-bit integers until a result names them.
SHORT = 1 << 15

LETTER, NUMBER, OTHER, SPACE, BETWEEN = range(5)
# The code points of Unicode's property White_Space.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
    0x205F, 0x3000,
)


@functools.cache
def _classes() -> np.ndarray:
    of = {"L": LETTER, "N": NUMBER}
    table = np.full(0x110000, OTHER, np.uint8)
    table[:LAST_WORD_POINT] = [
        of.get(unicodedata.category(chr(i))[0], OTHER) for i in range(LAST_WORD_POINT)
    ]
    table[list(WHITE_SPACE)] = SPACE
    return table


def words_of(texts: list[str], classes: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """The matches of public_tokenizers.PATTERN in all texts, as bytes, and how many each text has.

    classes says what each code point is (LETTER, NUMBER, OTHER or SPACE), if not Python's Unicode.

    Runs of letters, of numbers and of other characters are words, with one blank before them. Of
    white space before another character the last one stands apart; 's 't 're 've 'm 'll 'd are
    words where a word begins with the apostrophe.
    """
    joined = "\0".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    n = len(points)
    lengths = np.array([len(t) for t in texts], np.int64)
    between = np.cumsum(lengths + 1)[:-1] - 1
    kind = np.empty(n + 1, np.uint8)
    kind[:n] = (_classes() if classes is None else classes)[points]
    kind[between] = BETWEEN
    kind[n] = BETWEEN
    begins = np.ones(n + 1, bool)
    begins[1:] = kind[1:] != kind[:-1]
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] < SPACE))
    begins[last] = True
    begins[last[points[last] == 0x20] + 1] = False
    quote = np.flatnonzero((points == ord("'")) & begins[:n])
    ahead = np.zeros(n + 3, np.uint32)
    ahead[:n] = points
    ahead[between] = 0
    one, two = ahead[quote + 1], ahead[quote + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long_ = np.zeros(len(quote), bool)
    for a, b in ("re", "ve", "ll"):
        long_ |= (one == ord(a)) & (two == ord(b))
    for at, size in ((quote[short], 2), (quote[long_], 3)):
        begins[at + 1] = False
        begins[at + size] = True
    first = np.flatnonzero(begins[:n])
    size = np.ones(n, np.uint8)
    for least in (0x80, 0x800, 0x10000):
        size += points >= least
    ends = np.cumsum(size, dtype=np.int64)
    offsets = np.append(ends[first] - size[first], ends[-1] if n else 0).astype(np.int32)
    array = pa.Array.from_buffers(
        pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(joined.encode())]
    )
    is_word = kind[first] != BETWEEN
    text_of = np.searchsorted(between, first[is_word], side="left")
    return array.filter(pa.array(is_word)), np.bincount(text_of, minlength=len(texts))


def _last_cut(text: str) -> int:
    """The last place where a match ends for certain and another begins; 0 if there is none."""
    kind = _classes()[np.frombuffer(text.encode("utf-32-le"), "<u4")]
    one, two = kind[:-1], kind[1:]
    # Not after other characters: an apostrophe may take letters with it.
    safe = ((one != SPACE) & (two == SPACE)) | ((one < OTHER) & (two < SPACE) & (one != two))
    at = np.flatnonzero(safe)
    return int(at[-1]) + 1 if len(at) else 0


def parts_of(text: str, most: int = CHUNK_CHARS) -> list[str]:
    """The text in parts of at most most characters, which have the matches that it has."""
    parts, start = [], 0
    while len(text) - start > most:
        size, end = most, 0
        while not end and start + size < len(text):
            end = _last_cut(text[start : start + size + 1])
            size *= 2
        if not end:
            break
        parts.append(text[start : start + end])
        start += end
    parts.append(text[start:] if start else text)
    return parts


def in_parts(
    batches: Iterator[pa.RecordBatch], most: int = CHUNK_CHARS
) -> Iterator[tuple[list[int], list[str], list[int], list[int], pa.RecordBatch]]:
    """Pieces of about most characters: for each text or part of one the row of the batch, the
    characters, its position among the text's parts, how many these are; and the batch."""
    for batch, texts in chunks(batches, "text", most):
        if len(texts) == 1 and len(texts[0]) > most:
            parts = parts_of(texts[0], most)
            for i, part in enumerate(parts):
                yield [0], [part], [i], [len(parts)], batch
        else:
            yield list(range(len(texts))), texts, [0] * len(texts), [1] * len(texts), batch


BLOCK = (
    "block bigint, row bigint, doc_id bigint, part int, parts int, codes binary, word binary, "
    "number bigint"
)
_BLOCK = pa.schema(
    [("block", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("part", pa.int32()),
     ("parts", pa.int32()), ("codes", pa.binary()), ("word", pa.binary()), ("number", pa.int64())]
)


class _Block:
    """Texts as numbers of their words; one dictionary, which grows."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.uses = np.zeros(0, np.int64)
        self.texts: list[tuple] = []
        self.bytes = 0

    def add(self, rows: pa.Array, docs: pa.Array, part: list[int], parts: list[int], texts: list[str]) -> None:
        words, n = words_of(texts)
        coded = words.dictionary_encode()
        del words
        number, before = self.number, len(self.number)
        own = np.array([number.setdefault(w, len(number)) for w in coded.dictionary.to_pylist()], np.uint32)
        codes = own[coded.indices.to_numpy()] if len(own) else np.zeros(0, np.uint32)
        uses = np.bincount(codes, minlength=len(number))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        self.texts.append((rows, docs, part, parts, n, codes))
        self.bytes += codes.nbytes + (len(number) - before) * WORD_BYTES
        self.bytes += coded.dictionary.nbytes if len(number) > before else 0

    def rows(self) -> Iterator[pa.RecordBatch]:
        """A row a text or part (codes) and one a distinct word (word, number)."""
        block = uuid.uuid4().int >> 65
        # Frequent words get small numbers, whose upper bytes are 0.
        order = np.argsort(-self.uses, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        width = max(1, -(-len(order).bit_length() // 8))  # bytes that a number needs
        for rows, docs, part, parts, n, codes in self.texts:
            codes = rank[codes] if len(codes) else codes
            ends = np.cumsum(n)
            for start in range(0, len(rows), 1000):
                stop = min(start + 1000, len(rows))
                packed = [
                    # All lowest bytes, then all second ones...: like bytes compress together.
                    codes[a:b].view(np.uint8).reshape(-1, 4).T[:width].tobytes()
                    for a, b in zip(np.append(0, ends)[start:stop], ends[start:stop])
                ]
                k = stop - start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, block)), rows.slice(start, k), docs.slice(start, k),
                     pa.array(part[start:stop], pa.int32()), pa.array(parts[start:stop], pa.int32()),
                     pa.array(packed, pa.binary()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64())],
                    schema=_BLOCK,
                )
        words = np.array(list(self.number), object)
        for start in range(0, len(words), 50_000):
            part = pa.array(words[order[start : start + 50_000]], pa.binary())
            k = len(part)
            none = [pa.nulls(k, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, block)), *none, part, pa.array(np.arange(start, start + k))],
                schema=_BLOCK,
            )


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = _Block()
    for rows, texts, part, parts, batch in in_parts(batches, PIECE_CHARS):
        at = pa.array(rows)
        block.add(batch["row"].take(at), batch["doc_id"].take(at), part, parts, texts)
        if block.bytes >= BLOCK_BYTES:
            yield from block.rows()
            block = _Block()
            release()
    if block.texts:
        yield from block.rows()
    del block
    release()


def blocks(docs: DataFrame) -> DataFrame:
    """The blocks of docs as a table bucketed by block: BLOCK."""
    spark = docs.sparkSession
    rows = pick(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    split_bytes = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(split))
    n = rows.rdd.getNumPartitions()
    joined = max(spark.sparkContext.defaultParallelism, n // max(1, SPLIT_BYTES // split_bytes))
    if joined < n:
        rows = rows.coalesce(joined)
    allowed = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    name = f"millrace_blocks_{uuid.uuid4().hex}"
    (
        rows.mapInArrow(_block_rows, BLOCK)
        .write.option("compression", "zstd")
        .option("path", shared_dir(spark))
        .bucketBy(max(1, min(min(n, joined) * 4, allowed)), "block")
        .saveAsTable(name)
    )
    table = spark.table(name)
    # The files are the table's own folder's and stay; only the name goes.
    spark.sql(f"DROP TABLE {name}")
    return table


@functools.cache
def encoding(ranks: str) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
    )


@functools.cache
def token_bytes(ranks: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The table of token bytes: all bytes in the order of ids, where each id's begin, how many."""
    tokens = dict((int(b), base64.b64decode(a)) for a, b in map(bytes.split, open(ranks, "rb")))
    ordered = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
    size = np.array([len(t) for t in ordered], np.int64)
    return np.frombuffer(b"".join(ordered), np.uint8), np.cumsum(size) - size, size


def gather(
    values: np.ndarray, first: np.ndarray, size: np.ndarray, numbers: np.ndarray
) -> np.ndarray:
    """The pieces of values that begin at first[i] and have size[i] members, for i in numbers."""
    begin, length = first[numbers], size[numbers]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(begin - ends + length, length)]


def decode(ids: np.ndarray, ranks: str = RANKS) -> bytes:
    return gather(*token_bytes(ranks), ids.astype(np.int64)).tobytes()


def planes(x: np.ndarray) -> bytes:
    """Numbers below 2**32: all lowest bytes, then all second ones..."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes | pa.Buffer) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4")[:, 0]


def _by_block(block: np.ndarray, number: np.ndarray, size: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """One row a block: numbers (as steps from the one before), how many ids each has, and the ids."""
    order = np.lexsort((number, block))
    values = gather(values, np.cumsum(size) - size, size, order)
    block, number, size = block[order], number[order], size[order]
    cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    ends = np.append(cuts[1:], len(block))
    upto = np.append(0, np.cumsum(size))
    rows = [
        (planes(np.diff(number[a:b], prepend=0)), planes(size[a:b]), planes(values[upto[a] : upto[b]]))
        for a, b in zip(cuts, ends)
    ]
    packed = [pa.array(c, pa.binary()) for c in zip(*rows)]
    return pa.RecordBatch.from_arrays(
        [pa.array(block[cuts]), *packed], names=["block", "numbers", "sizes", "ids"]
    )


def word_ids(words: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Ids of rows (block, number, word): each distinct word is encoded once by the task that gets
    all its rows. Those of a block go back packed, up to PACKED_ROWS words of a task at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(ranks)._encode_single_piece
        held, n = [], 0

        def packed() -> pa.RecordBatch:
            return _by_block(*map(np.concatenate, zip(*held)))

        for batch in batches:
            if not len(batch):
                continue
            coded = batch["word"].dictionary_encode()
            own = [np.array(encode(w), np.uint32) for w in coded.dictionary.to_pylist()]
            size = np.array([len(x) for x in own], np.int64)
            at = coded.indices.to_numpy()
            values = gather(np.concatenate(own), np.cumsum(size) - size, size, at)
            held.append((batch["block"].to_numpy(), batch["number"].to_numpy(), size[at], values))
            n += len(at) + len(values)
            if n >= PACKED_ROWS:
                yield packed()
                held, n = [], 0
        if held:
            yield packed()
        held = []
        release()

    # Sorted, the rows of a word lie together, in one Arrow batch or two.
    return words.repartition("word").sortWithinPartitions("word").mapInArrow(
        run, "block bigint, numbers binary, sizes binary, ids binary"
    )


# One row a text or part; n, digests and ids are what finish() gives.
PART = "row bigint, doc_id bigint, part int, parts int"
Finish = Callable[[pa.Table, Iterator[np.ndarray]], pa.Table]


def assemble(docs: DataFrame, finish: Finish, schema: str, ranks: str = RANKS) -> DataFrame:
    """What finish makes of each block's rows (PART) and their ids in order, as a written table."""
    table = blocks(docs)
    words = table.where("word IS NOT NULL").select("block", "number", "word")
    texts = table.where("word IS NULL").select("block", "row", "doc_id", "part", "parts", "codes")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        release()

        # Where the ids of each of the block's numbers lie in what came back.
        def together(make: Callable, column: str) -> np.ndarray:
            return np.concatenate([np.zeros(0, np.uint32), *(make(x.as_buffer()) for x in right[column])])

        number = together(lambda x: np.cumsum(from_planes(x), dtype=np.uint32), "numbers")
        own = together(from_planes, "sizes").astype(np.int64)
        values = together(from_planes, "ids")
        first, size = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        first[number], size[number] = np.cumsum(own) - own, own
        width = max(1, -(-len(number).bit_length() // 8))

        def ids() -> Iterator[np.ndarray]:
            for packed in left["codes"]:
                planes = np.frombuffer(packed.as_buffer(), np.uint8).reshape(width, -1)
                codes = np.zeros((planes.shape[1], 4), np.uint8)
                codes[:, :width] = planes.T
                yield gather(values, first, size, codes.view("<u4")[:, 0])

        done = finish(left.select(["row", "doc_id", "part", "parts"]), ids())
        del number, own
        release()
        return done

    return durable(
        texts.groupBy("block").cogroup(word_ids(words, ranks).groupBy("block")).applyInArrow(
            run, f"{PART}, {schema}"
        )
    )


def in_pieces(
    rows: pa.Table, ids: Iterator[np.ndarray], columns: dict[str, pa.DataType], make: Callable
) -> pa.Table:
    """rows with what make(ids, is one of several parts) gives for columns, a few rows at a time,
    so that the ids of a block are held once."""
    schema = pa.schema([*rows.schema, *columns.items()])
    done, start = [], 0
    split = (rows["parts"].to_numpy() > 1).tolist()
    while start < len(rows):
        made = [make(x, split[start + i]) for i, x in enumerate(itertools.islice(ids, 500))]
        own = rows.slice(start, len(made))
        new = [pa.array(c, k) for c, k in zip(zip(*made), columns.values())]
        done.append(pa.table([*own.columns, *new], schema=schema))
        start += len(made)
    return pa.concat_tables(done) if done else schema.empty_table()


def encode_texts(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id and ids of each row."""

    def finish(rows: pa.Table, ids: Iterator[np.ndarray]) -> pa.Table:
        return in_pieces(rows, ids, {"ids": pa.list_(pa.int32())}, lambda x, _: (x.astype(np.int32),))

    done = assemble(docs, finish, "ids array<int>", ranks)
    several = done.where("parts > 1").groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("all")
    )
    return done.where("parts = 1").select("doc_id", "ids").unionByName(
        several.select("doc_id", F.flatten(F.transform("all", lambda x: x["ids"])).alias("ids"))
    )


def decode_texts(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id and text of rows (doc_id, ids); null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if x is None else decode(np.array(x, np.int64), ranks).decode()
                for x in batch["ids"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return pick(encoded, "doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame, ranks: str = RANKS, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of what they decode to, a row per row; with
    with_ids the ids, too."""
    shift = SHORT if len(token_bytes(ranks)[2]) <= 2 * SHORT else 0
    kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(),
             "ids": pa.list_(pa.int16() if shift else pa.int32())}

    def stored(x: np.ndarray) -> np.ndarray:
        return (x.astype(np.int32) - shift).astype(np.int16 if shift else np.int32)

    def finish(rows: pa.Table, ids: Iterator[np.ndarray]) -> pa.Table:
        def make(x: np.ndarray, split: bool) -> tuple:
            if split:
                return len(x), None, None, stored(x)
            return (
                len(x), hashlib.sha256(x.astype("<u4").tobytes()).hexdigest(),
                hashlib.sha256(decode(x, ranks)).hexdigest(), stored(x) if with_ids else None,
            )

        return in_pieces(rows, ids, kinds, make)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The parts of a text come one after the other and are digested as they come."""
        schema = pa.schema([("doc_id", pa.int64()), *list(kinds.items())[:3]])
        if with_ids:
            schema = schema.append(pa.field("ids", pa.list_(pa.int32())))
        for batch in batches:
            for doc, part, parts, values in zip(
                *(batch[c].to_pylist() for c in ("doc_id", "part", "parts")), batch["ids"]
            ):
                x = (values.values.to_numpy().astype(np.int32) + shift).astype("<u4")
                if part == 0:
                    count, one, two, held = 0, hashlib.sha256(), hashlib.sha256(), []
                count += len(x)
                one.update(x.tobytes())
                two.update(decode(x, ranks))
                if with_ids:
                    held.append(pa.array(x.astype(np.int32)))
                if part == parts - 1:
                    row = [[doc], [count], [one.hexdigest()], [two.hexdigest()]]
                    arrays = [pa.array(c, f.type) for c, f in zip(row, schema)]
                    if with_ids:
                        whole = pa.concat_arrays(held)
                        arrays.append(pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole))
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    done = assemble(docs, finish, f"{DIGESTS}, ids array<{'smallint' if shift else 'int'}>", ranks)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    several = (
        done.where("parts > 1")
        .select("row", "doc_id", "part", "parts", "ids")
        .repartition("row")
        .sortWithinPartitions("row", "part")
        .mapInArrow(together, f"doc_id bigint, {DIGESTS}" + (", ids array<int>" if with_ids else ""))
    )
    whole = done.where("parts = 1").select(*names)
    if with_ids:
        whole = whole.withColumn("ids", F.transform("ids", lambda x: x.cast("int") + F.lit(shift)))
    return whole.unionByName(several)
