"""op12 against a brute-force count, over many small shards."""

import random
import re
from collections import Counter

import pytest
from millrace.llm import op12_phrases as p

DOCS = "doc_id bigint, text string, lang string"


def brute(rows, minimum, longest=5, percent=100, best=2000):
    f, n = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = {}
    found = {key: c for key, c in f.items() if c >= minimum}
    for (lang, w), a in found.items():
        if len(w) == 1:
            continue
        score, _, l, r = min(
            (1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
            for k in range(1, len(w))
        )
        inside = any(
            x == lang and len(v) > len(w) and 100 * c >= percent * a
            and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
            for (x, v), c in found.items()
        )
        if not inside:
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted(
        (lang, i + 1, w.decode(), -a, l, r, n[lang], -s)
        for lang, rows in out.items() for i, (s, a, w, l, r) in enumerate(sorted(rows)[:best])
    )


def some(seed, n=300):
    r = random.Random(seed)
    words = ["A", "b", "C'est", "É", "été", "the", "x" * 40, "日本", "don't", " ", "e-mail"]
    rows = []
    for i in range(n):
        text = "".join(
            r.choices(words, [9, 8, 7, 5, 4, 4, 1, 2, 3, 1, 2])[0] + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?"])
            for _ in range(r.randrange(60))
        )
        rows.append((i, text, r.choice(["en", "en", "en", None, "fr", "und", ""])))
    rows += [(None, None, "en"), (1, "", None), (2, " \t.,", "xx"), (3, "the the the the the the the", "en")] + rows[:5] * 3
    return rows


@pytest.mark.parametrize("seed, minimum, percent, bits", [(1, 5, 100, 1 << 20), (2, 20, 60, 64), (3, 3, 90, 1 << 12)])
def test_equals_brute_force_over_small_shards(spark, monkeypatch, seed, minimum, percent, bits):
    monkeypatch.setattr(p, "SHARD_WORDS", 700)
    monkeypatch.setattr(p, "CHUNK_CHARS", 500)
    rows = some(seed)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    for c in ("phrase", "n", "total", "words", "length", "f", "rank", "_lang"):
        df = df.selectExpr("*", f"'extra' AS {c}")
    got = p.collocations(df, minimum, kept_percent=percent, bits=bits)
    assert sorted(map(tuple, got.collect())) == brute(rows, minimum, percent=percent)
    assert dict(got.dtypes) == dict(zip(got.columns, ["string", "bigint", "string"] + ["bigint"] * 5))
    few = p.collocations(df, minimum, kept_percent=percent, best=3, bits=bits)
    assert sorted(map(tuple, few.collect())) == brute(rows, minimum, percent=percent, best=3)


def test_local_support_leaves_little_to_count(spark):
    """In two shards of 300 sentences, what is rare in both is not a candidate."""
    texts = [f"w{i} v{i}. common pair" for i in range(600)]
    df = spark.createDataFrame([(t, "en", 2400) for t in texts], "text string, lang string, total bigint")
    words = spark.createDataFrame([("en", w) for t in texts for w in re.split("[ .]+", t)], "lang string, phrase string").distinct()
    known = spark.sparkContext.broadcast(p._known(words, 1 << 16))
    bits = p._gathered(p._mined(df.repartition(2), known, 2, 2, 100, 1 << 16), 1 << 16)
    assert sum(int(x).bit_count() for x in bits) == 1


def test_empty_and_long(spark):
    none = spark.createDataFrame([], DOCS)
    assert p.collocations(none).count() == 0
    assert p.collocations(spark.createDataFrame([(1, None, None), (2, " ", "en")], DOCS)).count() == 0
    text = "one two three, " * 250_000
    rows = p.collocations(spark.createDataFrame([(1, text, None), (2, "four " * 3000, "en")], DOCS)).collect()
    n, m = 250_000, 750_000
    assert [tuple(r) for r in rows if r.lang == "und"] == [("und", 1, "one two three", n, n, n, m, 1000 * n * m // (n * n))]
    assert {(r.phrase, r.a) for r in rows if r.lang == "en"} == {
        (" ".join(["four"] * k), 3001 - k) for k in range(2, 6)
    }


def test_parts_are_cut_at_breaks():
    text = "ab cd. ef" * 50 + "x" * 400 + ", tail"
    parts = p.parts_of(text, 100)
    assert "".join(parts) == text and all(x[-1] in p.BREAKS for x in parts[:-1]) and len(parts) > 4


def test_many_shards_do_not_make_more_to_count(spark):
    """In 20 shards the support is 5: 30 pairs a shard that occur 5 times there and nowhere else are
    candidates of their shards, but cannot come to 100."""
    texts = [(s, f"a{s}x{i} b{s}x{i}. common pair") for s in range(20) for i in range(30) for _ in range(5)]
    df = spark.createDataFrame([(s, t, "en", 4 * len(texts)) for s, t in texts], "s int, text string, lang string, total bigint")
    df = spark.createDataFrame(df.rdd.map(tuple).keyBy(lambda r: r[0]).partitionBy(20, int).values(), df.schema).drop("s")
    words = spark.createDataFrame([("en", w) for _, t in set(texts) for w in re.split("[ .]+", t)], "lang string, phrase string").distinct()
    bits = 1 << 16
    known = spark.sparkContext.broadcast(p._known(words, bits))
    mined = p._mined(df, known, 2, 2, 100, bits).cache()
    assert mined.count() <= 2 * 20  # a block of bits and one of sums a shard
    both = p._together(mined, bits, 100)
    assert sum(int(x).bit_count() for x in both[0]) > 500
    counted = p._counted(df, known, spark.sparkContext.broadcast(both), 2, 2)
    found = {r.phrase for r in counted.collect()}
    assert "common pair" in found and len(found) < 20
