"""Repeated rows, empty tables and clashing names: operators and the pipeline's own forms."""

import hashlib

import corpus_pipeline
import duckdb
import pytest
from millrace.llm import op01_html, op02_urls, op03_mix, op05_toxicity, op06_bpe, op07_chat, op09_pii, op10_dartminhash

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TURNS = "conv_id bigint, turn bigint, role string, text string"
EXTRA = ("size", "h", "score", "digest", "copies", "split", "number", "made", "_at", "_part", "host", "reply")


def clashing(df):
    return df.selectExpr("*", *[f"'extra' AS {c}" for c in EXTRA if c not in df.columns])


# --- 3


def mix_against_sql(got, docs):
    with duckdb.connect() as con:
        con.register("documents", docs.toArrow())
        want = con.sql(op03_mix.MIX_SQL).fetchall()
        names = [d[0] for d in con.sql(op03_mix.MIX_SQL).description]
    rows = [tuple(r[n] for n in names) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("alike", [1, 2, 7, 1000])
def test_a_source_of_one_repeated_row_comes_within_a_row_of_its_target(spark, alike):
    rows = [(5, "a b c d", "en", "one", 7)] * alike + [(i, f"w{i} " * (i % 9 + 1), "en", "two", 1) for i in range(900)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    got = op03_mix.mix_sources(docs)
    mix_against_sql(got, docs)
    sums = got.groupBy("source").agg({"target": "first", "taken": "sum", "copies": "max"}).collect()
    for r in sums:
        size = 4 if r["source"] == "one" else 9
        assert abs(r["sum(taken)"] - r["first(target)"]) <= size
        assert r["max(copies)"] <= 2
    assert got.count() == len(rows)
    # The rows of the mix follow the same decision, and keep columns of any name.
    mixed = op03_mix.mixed_rows(clashing(docs))
    assert mixed.columns == clashing(docs).columns
    want = {r["source"]: r["sum(taken)"] for r in sums}
    words = mixed.selectExpr("source", "size(split(trim(text), ' ')) AS n").groupBy("source").sum("n").collect()
    assert {r["source"]: r["sum(n)"] for r in words} == {s: n for s, n in want.items() if n}


def test_budgets_that_end_among_repeated_rows_of_several_sources(spark):
    rows = []
    for s, texts in {"a": 301, "b": 77, "c": 2000, None: 50}.items():
        rows += [(None, "x y z", None, s, None)] * texts + [(i, "p " * (i % 4), "en", s, 0) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    got = op03_mix.mix_sources(docs)
    mix_against_sql(got, docs)
    for r in got.groupBy("source").agg({"target": "first", "taken": "sum"}).collect():
        assert abs(r["sum(taken)"] - r["first(target)"]) <= 3
    again = op03_mix.mix_sources(docs).groupBy("doc_id", "source").agg({"taken": "sum"})
    first = got.groupBy("doc_id", "source").agg({"taken": "sum"})
    assert again.exceptAll(first).isEmpty() and first.exceptAll(again).isEmpty()


# --- 1, 2


def test_pages_with_clashing_names_repeated_and_long_rows_or_none(spark):
    long = "<article>" + "<p>Some words, of a page.</p>" * 30_000 + "</article>"
    rows = [
        (1, "http://A.example.org/en/1?q", "<p>one"), (1, "http://A.example.org/en/1?q", "<p>one"),
        (2, None, None), (None, "no url", ""), (3, "http://example.com/fr/x", long),
    ]
    pages = clashing(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    texts = {(r.page_id, r.text if r.page_id != 3 else "", r.n_chars) for r in op01_html.extract(pages).collect()}
    assert texts == {(1, "one", 3), (2, "", 0), (None, "", 0), (3, "", 30_000 * 23 - 1)}
    judged = op02_urls.judge(pages).collect()
    assert len(judged) == len(rows) and len(set(judged)) == len(rows) - 1
    by_id = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged}
    assert by_id[1] == ("a.example.org", "/en/1", "example.org/en/1", "block")
    assert by_id[2][:3] == by_id[None][:3] == ("", "", None)
    assert by_id[3] == ("example.com", "/fr/x", "com/fr/", "allow")
    assert op01_html.extract(pages.where("false")).isEmpty()
    assert op02_urls.judge(pages.where("false")).isEmpty()


# --- 7


def test_conversations_with_ties_nulls_repeats_and_clashing_names(spark):
    rows = [
        (1, 0, "user", "hi <b>"), (1, 1, "assistant", "\\yes\\"), (1, 1, "assistant", "\\yes\\"),
        (1, None, "system", None), (2, 0, "user", "only"), (None, 0, "assistant", "x" * 300_000), (None, 0, None, ""),
        (3, 5, "assistant", ""), (3, 6, "assistant", "</turn>\n<turn assistant>\n"),
    ]
    table = clashing(spark.createDataFrame(rows, TURNS))
    formatted = op07_chat.format_turns(table)
    got = {r.conv_id: r for r in op07_chat.read_back(formatted).collect()}
    assert set(got) == {1, 2, 3, None}
    for conv, r in got.items():
        own = sorted(
            ((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv)
        )
        digest = hashlib.sha256("".join(f"{role}\n{text}\n" for *_, role, text in own).encode()).hexdigest()
        loss = "".join(text for *_, role, text in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), digest)
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert op07_chat.read_back(op07_chat.format_turns(table.where("false"))).isEmpty()
    # Each context is what stands before the example's segment.
    text = {}
    for r in sorted(formatted.collect(), key=lambda r: (str(r.conv_id), r.position)):
        if r.reply:
            before = text.get(r.conv_id, "")
            assert r.context_chars == len(before)
        text[r.conv_id] = text.get(r.conv_id, "") + r.segment
    contexts = {(r.conv_id, r.example): r.context for r in op07_chat.materialize(formatted).collect()}
    made = op07_chat.examples(formatted).collect()
    assert len(made) == 5
    for r in made:
        assert contexts[r.conv_id, r.example] == text[r.conv_id][: r.context_chars]


def test_reading_back_refuses_examples_that_do_not_fit(spark):
    from pyspark.sql import functions as F

    table = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], TURNS)
    formatted = op07_chat.format_turns(table)
    for c in ("context_chars", "example"):
        with pytest.raises(Exception, match="does not fit"):
            op07_chat.read_back(formatted.withColumn(c, F.col(c) + 1)).collect()


def test_every_reply_is_expanded_with_its_context(spark, monkeypatch):
    """Contexts are texts, whole or going on from an earlier example, and grow with the turns only."""
    monkeypatch.setattr(op07_chat, "PREFIX_CHARS", 500)
    rows = [(c, t, "assistant" if t % 3 == 1 else "user", f"<{c}> turn {t}" * (1 + t % 4))
            for c, n in ((1, 200), (2, 2), (3, 1), (None, 5)) for t in range(n)]
    formatted = op07_chat.format_turns(spark.createDataFrame(rows, TURNS))
    whole = {}
    for r in sorted(formatted.collect(), key=lambda r: (str(r.conv_id), r.position)):
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.segment
    made = op07_chat.expanded(formatted).collect()
    ends = {(c, 0) for c in whole}
    for r in made:
        assert r.context == whole[r.conv_id][r.held_from : r.context_chars]
        assert r.target == whole[r.conv_id][r.context_chars :][: len(r.target)]
        assert r.example is not None or r.context_chars == len(whole[r.conv_id])
        assert (r.conv_id, r.held_from) in ends
        ends.add((r.conv_id, r.context_chars + len(r.target)))
        assert len(r.context) < 1_000
    assert sum(r.example is not None for r in made) == sum(role == "assistant" for _, _, role, _ in rows)
    assert all(r.held_from == 0 for r in made if r.conv_id != 1) and any(r.held_from for r in made)
    got = {r.conv_id: r for r in op07_chat.read_back(formatted).collect()}
    for c, text in whole.items():
        loss = "".join(x for d, _, role, x in rows if d == c and role == "assistant")
        assert (got[c].formatted_chars, got[c].loss_sha256) == (len(text), hashlib.sha256(loss.encode()).hexdigest())


# --- pipeline


def test_stages_take_empty_tables_nulls_repeats_and_clashing_names(spark):
    words = "many different words stand in this one document, as in no other of them"
    rows = [(1, words, "en", "s", 3), (1, words, "en", "s", 3), (2, words, None, None, None), (3, None, "en", "s", None),
            (4, "", "en", "t", 0), (None, "mail me at me@example.com", "de", "t", 9)]
    docs = clashing(spark.createDataFrame(rows, DOCS))
    labels = spark.createDataFrame([(1, None, 0), (2, 0, 1)], "doc_id bigint, quality int, toxic int")
    model = op05_toxicity.train(docs, labels)
    forms = {
        "toxicity": lambda d: op05_toxicity.without_toxic(d, model),
        "near_duplicates": op10_dartminhash.one_of_each_class,
        "pii": op09_pii.redacted,
        "mix": op03_mix.mixed_rows,
    }
    assert list(forms) == [name for name, _ in corpus_pipeline.STAGES[:-1]]
    for name, form in forms.items():
        got = form(docs)
        assert got.columns == docs.columns, name
        assert got.count() <= 2 * len(rows), name
        assert form(docs.where("false")).isEmpty(), name
    assert forms["pii"](docs).where("text LIKE '%@%'").isEmpty()
    assert op06_bpe.digests(docs, with_ids=True).count() == len(rows)
    assert op06_bpe.digests(docs.where("false"), with_ids=True).isEmpty()
