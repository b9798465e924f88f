"""op13: every id in one piece, sequences without gaps or padding, ids as the tokenizer gives them."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from millrace.llm import op13_packing as p
from millrace.llm import queries

DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def plain():
    return p.tokenizer(p.VOCABULARY)


def expected(plain, texts):
    return [x.ids + [0] for x in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, texts, plain, window=1024):
    """rows against brute force; a text's place in the list is its doc_id."""
    ids = expected(plain, texts)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == list(range(len(texts)))
    for d, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids[d])
            own = np.array(ids[d][at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(own) and len(own) == 4 * r.length
            at += r.length
        assert at == len(ids[d])
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        # Nothing is padded: each sequence is full, and a power of two.
        assert {r.window for r in pieces} == {at} and at <= window and at & (at - 1) == 0
    return by_sequence


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, plain, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
    rows = queries.op13_packing_tiers(spark, f"/root/testdata/{sf}").collect()
    assert sorted(docs) == list(range(len(docs)))
    sequences = check(rows, [docs[i] for i in range(len(docs))], plain)
    # Step groups hold like numbers of ids and of windows.
    ids, windows = {}, {}
    for pieces in sequences.values():
        group = pieces[0].step_group
        ids[group] = ids.get(group, 0) + pieces[0].window
        windows[group] = windows.get(group, 0) + 1
    assert max(ids.values()) - min(ids.values()) <= 1024
    assert max(windows.values()) - min(windows.values()) <= 1


def test_edges(spark, plain, monkeypatch):
    monkeypatch.setattr(p, "CHUNK_CHARS", 5000)
    new = "".join(chr(c) for c in (0x1C89, 0xA7CB, 0x105C0, 0x2EBF0, 0x558, 0x16D40))
    texts = [
        None, "", "a", "a", "<|endoftext|> is text", "x " * 3000, "é" * 30_000, "word " * 4000 + "1a2b" * 9000,
        f"a{new}1 '{new}s can't", "'s" * 4000, "\n  " * 5000, "hello world " * 93, "tie", "tie",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    for c in ("ids", "rest", "rank", "full", "task", "tokens", "window"):
        df = df.selectExpr("*", f"'extra' AS {c}")
    rows = p.pack(df.repartition(3)).collect()
    check(rows, texts, plain)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32
    assert p.pack(df.where("false")).count() == 0
    # Repeated rows and null ids are documents of their own.
    twice = p.pack(df.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text").union(df.select("doc_id", "text")))
    assert twice.agg({"length": "sum"}).first()[0] == 2 * sum(map(len, expected(plain, texts)))
    assert twice.where("doc_id IS NULL AND start = 0").count() == len(texts)


def test_long_text(spark, plain):
    text = "".join(random.Random(1).choices("abcdefgh  .1", k=3_000_000))
    rows = p.pack(spark.createDataFrame([(0, text), (1, "b")], DOCS), with_ids=False).collect()
    check(rows, [text, "b"], plain)


@pytest.mark.parametrize("seed", range(60))
def test_plan(seed):
    r = random.Random(seed)
    window = r.choice([1, 2, 8, 64, 1024])
    least = r.choice([x for x in (1, 2, 8, 64, 1024) if x <= window])
    counts = {r.randrange(window): r.randrange(1, 60) for _ in range(r.randrange(50))}
    plan = p.Plan(counts, window, least)
    pairs = [(rest, i) for rest, n in counts.items() if rest for i in range(n)]
    rest, rank = (np.array([x[k] for x in pairs], np.int64) for k in (0, 1))
    doc, start, length, sequence, offset = plan.pieces(rest, rank)
    for owner, at, sizes in ((doc, start, rest), (sequence, offset, None)):
        ends = {}
        for i in np.lexsort((at, owner)):
            assert at[i] == ends.get(owner[i], 0)
            ends[owner[i]] = at[i] + length[i]
        if sizes is not None:
            assert [ends[i] for i in range(len(sizes))] == sizes.tolist()
        else:
            full = [ends[i] for i in range(plan.sequences)]
            assert all(x & (x - 1) == 0 for x in full) and full == sorted(full, reverse=True)


def test_plan_does_not_grow_with_the_data():
    counts = {i: 1 + i * 7919 % 977 for i in range(1, 1024)}
    small, large = p.Plan(counts), p.Plan({k: n * 1_000_003 for k, n in counts.items()})
    assert len(large.piece) < 2 * len(small.piece) < 20_000


def test_vocabulary_is_read_as_documented():
    assert p.VOCABULARY == public_tokenizers.path("byte_bpe_50k.json")
