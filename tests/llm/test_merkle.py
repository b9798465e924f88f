"""op11 against a brute-force tree; the query itself is compared with SQL in test_queries.py."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from millrace.llm import op11_merkle as m
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(leaves, k):
    """The root and each leaf's steps: (siblings before it, siblings after it)."""
    level, groups, steps = list(leaves), [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(level) > 1:
        runs = [range(i, min(i + k, len(level))) for i in range(0, len(level), k)]
        for run in runs:
            for x in run:
                step = ("".join(level[y] for y in run if y < x), "".join(level[y] for y in run if y > x))
                for i in groups[x]:
                    steps[i].append(step)
        groups = [[i for x in run for i in groups[x]] for run in runs]
        level = [h(*(level[x] for x in run)) for run in runs]
    return level[0], steps


def brute(rows, k=2):
    if not rows:
        return []
    by_lang = defaultdict(list)
    for doc_id, text, lang, source, n in rows:
        struck = doc_id is not None and n is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        one = leaf(doc_id, source, lang, n, text)
        two = leaf(doc_id, source, lang, n + 1, text) if struck else one
        by_lang[lang].append((doc_id is not None, doc_id or 0, one, two, doc_id))
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([r[2] for r in sorted(by_lang[x])], k) for x in order}
    root, upper = tree([trees[x][0] for x in order], k)
    out = []
    for x, above in zip(order, upper):
        for r, steps in zip(sorted(by_lang[x]), trees[x][1]):
            value = r[3]
            for a, b in steps + above:
                value = h(a, value, b)
            path = "".join(a + b for a, b in steps + above)
            out.append((r[4], r[2], trees[x][0], root, h(path), value, value == root))
    return sorted(out, key=repr)


def rows_of(n):
    rows = [(i, f"text {i}" * (i % 4), ["en", "de", "fr", None, ""][i * i % 5], f"s{i % 2}" if i % 3 else None, i or None) for i in range(n)]
    return rows + rows[1:3] * 4 + [
        (None, "no id", "en", None, 4), (None, None, None, None, None), (5, "other row", "en", "s", 2**63 - 1),
        (21, "é😀\0", "one", "ß", 2**63 - 1), (8, "x" * 300_000, "de", "s", 0), (2**63 - 1, "", "\U0001F600", "", -1), (-5, "", "￿", "", -1),
    ]


@pytest.mark.parametrize("n", [0, 40])
def test_equals_brute_force(spark, n):
    rows = rows_of(n)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    for c in ("at", "n", "g", "digest", "path", "key", "group", "level", "_read"):
        df = df.selectExpr("*", f"'extra' AS {c}")
    assert sorted(map(tuple, m.proofs(df).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("rows", [[], rows_of(0)[-1:], [(1, "a", None, None, None)] * 9])
def test_few_rows(spark, rows):
    got = m.proofs(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


@pytest.mark.parametrize("k", [3, 5])
def test_wider_trees(spark, k):
    rows = rows_of(30)
    got = m.manifest(spark.createDataFrame(rows, DOCS), fanout=k).select(
        F.col("key").alias("doc_id"), m.hexed(F.col("leaf")).alias("leaf"), m.hexed(F.col("subroot")).alias("subroot"),
        m.hexed(F.col("root")).alias("root"), m.proof(F.col("path")).alias("proof"),
        m.folded(F.col("leaf"), F.col("path")).alias("folded"),
    ).collect()
    assert all(r.folded == r.root for r in got)
    assert sorted(map(tuple, (r[:5] for r in got)), key=repr) == sorted((x[:5] for x in brute(rows, k)), key=repr)


def test_any_change_is_seen(spark):
    rows = rows_of(5)[:5]
    root = m.manifest(spark.createDataFrame(rows, DOCS)).first()["root"]
    for i, column in ((1, 1), (3, 3), (4, 4)):
        other = [list(r) for r in rows]
        other[i][column] = 77 if column == 4 else "changed"
        assert m.manifest(spark.createDataFrame(other, DOCS)).first()["root"] != root
