"""What a Python worker holds while it goes through one batch of ordinary documents, and after."""

import base64
import hashlib
import os
import subprocess
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
from millrace.llm import op05_toxicity, op06_bpe, op10_dartminhash
from millrace.llm.common import chunks


def peak_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def batch(n=5_000, words=300):
    r = np.random.default_rng(1)
    names = np.array([f"word{i}" for i in range(5_000)])
    texts = [" ".join(names[r.integers(0, len(names), words)]) + "." for _ in range(n)]
    number = pa.array(range(n))
    return pa.RecordBatch.from_arrays([number, number, pa.array(texts)], names=["row", "doc_id", "text"])


def test_pieces_are_made_without_the_whole_batch():
    rows = batch()

    def run():
        for _ in chunks([rows], "text", 100_000):
            pass

    assert peak_mb(run) < 5  # the batch's texts take 12 MB


def test_pieces_hold_all_rows_in_order():
    texts = ["a" * (i % 7) if i % 5 else None for i in range(1_203)] + ["b" * 50, "", None]
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["i", "text"])
    found = list(chunks([rows.slice(0, 0), rows], "text", 40))
    assert [i for part, _ in found for i in part["i"].to_pylist()] == list(range(len(texts)))
    assert [t for _, own in found for t in own] == [t or "" for t in texts]
    assert all(part.num_rows == len(own) for part, own in found)
    assert all(sum(map(len, own)) <= 40 or len(own) == 1 for _, own in found)


def test_scoring_holds_little():
    rows = batch(2_000)
    model = op05_toxicity.Model(-9.0, np.zeros(op05_toxicity.DIMENSION))

    def run():
        for _, texts in chunks([rows], "text", op05_toxicity.CHUNK_CHARS):
            b = op05_toxicity.bags(texts)
            op05_toxicity.document_scores(op05_toxicity.sentence_scores(b, model), b.owner, len(texts))

    assert peak_mb(run) < 70


def test_sketching_holds_little():
    rows = batch(2_000)

    def run():
        for _, texts in chunks([rows], "text", op10_dartminhash.CHUNK_CHARS):
            op10_dartminhash.signatures(*op10_dartminhash.elements(texts), len(texts))

    assert peak_mb(run) < 60


def test_blocks_hold_little_besides_their_words():
    rows = batch(2_000)
    op06_bpe._classes()

    def run():
        for _ in op06_bpe._block_rows(iter([rows])):
            pass

    assert peak_mb(run) < 30


GIVES_BACK = """
import re
import numpy as np
import pyarrow as pa
from millrace.llm import op06_bpe

def held():
    return sum(map(int, re.findall(r"Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1000

def batches():
    r = np.random.default_rng(1)
    for k in range(4):
        texts = [" ".join(map(str, r.integers(k * 10**6, (k + 1) * 10**6, 300))) for _ in range(2_000)]
        number = pa.array(range(len(texts)))
        yield pa.RecordBatch.from_arrays([number, number, pa.array(texts)], names=["row", "doc_id", "text"])

op06_bpe._classes()
before = held()
for _ in op06_bpe._block_rows(batches()):
    pass
print(held() - before)
"""


def test_a_worker_gives_back_what_it_freed():
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    made = subprocess.run([sys.executable, "-c", GIVES_BACK], cwd=repo, capture_output=True, text=True, check=True)
    assert float(made.stdout) < 85  # what freed words left between others stays


def kept_ids(spark, monkeypatch, docs, ranks):
    """The rows of digests and of what type the ids are in the tables it writes on the way."""
    kept, write = [], op06_bpe.durable

    def spy(df):
        kept.append(df.schema["ids"].dataType.elementType.simpleString())
        return write(df)

    monkeypatch.setattr(op06_bpe, "durable", spy)
    return op06_bpe.digests(spark.createDataFrame(docs, "doc_id bigint, text string"), ranks, with_ids=True), kept


def test_ids_that_fit_are_kept_in_two_bytes(spark, monkeypatch):
    encoding = op06_bpe.encoding(op06_bpe.RANKS)
    high = next(encoding.decode([i]) for i in range(encoding.n_vocab - 1, 0, -1) if b" " not in encoding.decode_bytes([i]))
    long = f"{high} words 12 and été\n" * (3 * op06_bpe.PIECE_CHARS // 20)
    docs = [(1, f"{high} {high}"), (2, long), (3, None), (4, "a"), (None, "plain"), (4, "a")]
    got, kept = kept_ids(spark, monkeypatch, docs, op06_bpe.RANKS)
    assert got.schema["ids"].dataType.elementType.simpleString() == "int"
    want = [(d, encoding.encode_ordinary(t or "")) for d, t in docs]
    assert max(want[0][1]) > 32_767
    rows = got.collect()
    assert sorted((str(r.doc_id), r.ids) for r in rows) == sorted((str(d), x) for d, x in want)
    assert all(r.n_tokens == len(r.ids) for r in rows)
    assert {r.ids_sha256 for r in rows} == {hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest() for _, x in want}
    assert kept == ["smallint"]


def test_ids_that_do_not_fit_are_kept_whole(spark, monkeypatch, tmp_path):
    ranks = tmp_path / "ranks.tiktoken"
    tokens = [(bytes([i]), i) for i in range(256)] + [(b"ab", 70_000)]
    ranks.write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for t, i in tokens))
    got, kept = kept_ids(spark, monkeypatch, [(1, "abb"), (2, "")], str(ranks))
    assert sorted((r.doc_id, r.ids) for r in got.collect()) == [(1, [70_000, 98]), (2, [])]
    assert kept == ["int"]
