"""The registered queries against DuckDB where SQL can express them, and edge cases of all."""

import hashlib
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pytest
import regex
from millrace.llm import (
    op01_html,
    op02_urls,
    op03_mix,
    op04_media,
    op05_toxicity,
    op06_bpe,
    op07_chat,
    op08_quality,
    op09_pii,
    op10_dartminhash,
    queries,
)
from millrace.sources import SCHEMAS

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WITHOUT_SQL = {"op1_html", "op2_urls", "op4_media", "op5_toxicity", "op6_bpe", "op9_pii", "op10_dartminhash", "op13_packing"}

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "word " * 40_000 + "é" * 50_000
TEXTS = [
    None, "", " \n\t", "short", "The cat sat on the mat with a hat and a bat, and that was that.",
    "The cat sat on the mat with a hat and a bat, and that was that.", LONG, LONG + " tail",
    "x@y.example.com and 10.0.0.1, +1 (663) 555-6869 4111 1111 1111 1111 \\ < > </turn>",
    "!!! ??? ...", "\u00a0\u2003é\u0301 中文 😀", "a\n" * 500,
]


def documents(spark, clash=True):
    """Rows with nulls in every column, ties, repeats, long texts and clashing extra columns."""
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, None) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (None, "no id at all, but five words", None, None, None)] * 2
    df = spark.createDataFrame(rows, DOCS)
    if clash:
        for name in ("size", "h", "score", "digest", "node", "label", "words", "copies", "block"):
            df = df.selectExpr("*", f"'extra' AS {name}")
    return df


def check_duck(name, got, sf_dir):
    with duckdb.connect() as con:
        for table in SCHEMAS:
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
        want = con.sql(queries.ORACLE_SQL[name])
        assert sorted(got.columns) == sorted(want.columns)
        order = sorted(want.columns)
        rows = [tuple(r[c] for c in order) for r in got.collect()]
        at = [want.columns.index(c) for c in order]
        other = [tuple(r[i] for i in at) for r in want.fetchall()]
        assert sorted(rows, key=repr) == sorted(other, key=repr)
        kinds = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}
        assert dict(got.dtypes) == {c: kinds[str(t)] for c, t in zip(want.columns, want.types)}


def test_each_query_has_sql_or_is_listed():
    assert set(queries.QUERIES) == set(queries.ORACLE_SQL) | WITHOUT_SQL
    assert not set(queries.ORACLE_SQL) & WITHOUT_SQL
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in queries.QUERIES) == 1


@pytest.mark.parametrize("sf_dir", [SMALL, MIDDLE])
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_duckdb(spark, name, sf_dir):
    check_duck(name, queries.QUERIES[name](spark, sf_dir), sf_dir)


def test_no_operator_fails_on_an_empty_table_or_edge_rows(spark):
    labels = spark.createDataFrame([(1, None, 1), (None, 0, 0), (4, 1, None)], "doc_id bigint, quality int, toxic int")
    ops = {
        "mix": op03_mix.mix_sources, "media": op04_media.media,
        "toxicity": lambda d: op05_toxicity.toxicity(d, labels), "bpe": op06_bpe.digests,
        "quality": op08_quality.quality, "pii": op09_pii.find_personal,
        "near": op10_dartminhash.near_duplicates,
    }
    docs, none = documents(spark), documents(spark).where("false")
    n = docs.count()
    for name, op in ops.items():
        assert op(docs).count() == n, name
        assert op(none).count() == 0, name


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="text"):
        op08_quality.quality(spark.range(1).withColumnRenamed("id", "doc_id"))


# --- 1


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site">Site name</header><nav><ul><li><a href=/a>Home</a></ul></nav>
<div id="cookie-notice">We use, cookies, a lot</div>
<div class="wrap"><div class="sidebar">Side, bar, with, commas</div>
<article><h1>Head &amp; line</h1><p>One <b>bo</b>ld,<br>two&nbsp;&eacute;.<p>Three
  four<ul><li>i1<li>i2</ul><div class="ad">Buy</div><form>Name <input></form>
<script>var t="</p>";</script><pre>a  b</pre></article>
<section class="comments"><p>Great, article, loved, it, so, much, indeed</p></section></div>
<footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a", "a"), ("<nav>x</nav>", ""),
        (PAGE, "Head & line One bold, two é. Three four i1 i2 a b"),
        ("<article><p>cut of&am", "cut of&am"), ("<article><p>in a tag<b", "in a tag"),
        ("<article><p>a</p><!-- never closed <p>b", "a"), ("<article>x<script>y", "x"),
        ("<div><p>Long one, with commas, and so on</p><p>b</p></div><div class=comment-list>no</div>",
         "Long one, with commas, and so on b"),
    ],
)
def test_main_text(page, text):
    assert op01_html.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ('<article><div><p class="ad">Buy<p>Real one</p><p>Real two</p></div><p>Three</p></article>',
         "Real one Real two Three"),
        ('<article><ul><li class="share">Share<li>One<li>Two</ul><p>Three</p></article>', "One Two Three"),
        ('<article><div><aside>Side<p>x</div><p>Text, long</p></article>', "Text, long"),
        ('<article><p>A <span class="ad">Buy<p>Next</article>', "A Next"),
        ("<article><ul><li><nav><li>x<div></nav>y</ul><p>z</p></article>", "y z"),
        ('<article><table><tr><td class="ad">x<td>y<tr><td>z</table></article>', "y z"),
        ("<article><span>a<aside>x</span>y</aside>b</span></article>", "a b"),
    ],
)
def test_what_is_left_out_ends_like_what_is_kept(page, text):
    assert op01_html.main_text(page) == text


BODY = "<p>Some text, of a sentence, with commas, that is long enough to count as one.</p>" * 3
PLAIN = " ".join(["Some text, of a sentence, with commas, that is long enough to count as one."] * 3)


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<main><h1>Title</h1><article>{BODY}</article></main>", f"Title {PLAIN}"),
        (f"<main><header><h1>Title</h1></header><article>{BODY}</article></main>", f"Title {PLAIN}"),
        (f"<main><article>{BODY}</article><article>{BODY}</article></main>", f"{PLAIN} {PLAIN}"),
        (f"<main><article>{BODY}</article><p>And so on.</p></main>", f"{PLAIN} And so on."),
        (f"<article><h1>Title</h1><article>{BODY}</article><p>End.</p></article>", f"Title {PLAIN} End."),
        (f"<body><nav>no</nav><article>{BODY}</article><div class=comments>no, no, no</div></body>", PLAIN),
        (f"<main><article>{BODY}</article><ul><li><a href=x>Other page</a></ul></main>", PLAIN),
    ],
)
def test_siblings_of_an_article(page, text):
    assert op01_html.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f'<div class="content no-sidebar">{BODY}</div>', PLAIN),
        (f'<div class="entry has-share">{BODY}</div>', PLAIN),
        (f'<div class="post with_comments"><div class="no-ads">{BODY}</div></div>', PLAIN),
        (f'<article class="post no-comments">{BODY}</article>', PLAIN),
        (f'<article class="comments-open sidebar" id="reply">{BODY}</article>', PLAIN),
        (f'<article>{BODY}<section id="discussion"><h2 id="related-work">Related</h2>{BODY}</section>'
         '<h2 id="share">Share</h2><p id="notice-1">Note</p></article>', f"{PLAIN} Related {PLAIN} Share Note"),
        ("<article><p>If <math><mi>x</mi><mo>&lt;</mo><mn>1</mn></math> then</p><xmp><b>&amp;</xmp>end</article>",
         "If x<1 then <b>&amp; end"),
        ("<article><p>a</p><div class=ad><xmp>b</xmp><math><mi>c</mi></math></div><p>d</p></article>", "a d"),
        *((f'<article><p>a</p><div {x}>no</div><p>b</p></article>', "a b") for x in (
            "class=ad", "class=ad-slot", 'class="x comments-area"', "class=post-comments", "id=comments", "id=comment-list",
            "class=related-posts", "class=share-buttons", "class=site-header", "id=cookie-notice", "class=entry-share",
            "id=sidebar", "class=newsletter-signup", "class=nav_menu_2", "id=disqus_thread", "class=social-links")),
    ],
)
def test_names_of_text_are_not_taken_for_notices(page, text):
    assert op01_html.main_text(page) == text


def test_html_query_reads_every_article_whole(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{MIDDLE}/pages.parquet").collect()}
    rows = queries.op1_html(spark, MIDDLE).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = regex.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id], regex.S)[1]
        blocks = regex.split(r"</?(?:p|br|h1)>", body.replace("<b>", "").replace("</b>", ""))
        want = " ".join(" ".join(html.unescape(b).split()) for b in blocks if b.strip())
        assert r.text == want and r.n_chars == len(want)


# --- 2


def test_urls(spark):
    urls = [
        ("http://WWW.Example.ORG/es/1?x#y", "www.example.org", "/es/1", "example.org/es/", "block"),
        ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("https://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
        ("x://a.com/fr/", "a.com", "/fr/", "com/fr/", "allow"),
        ("x://a.com/de/x://b", "a.com", "/de/x://b", "com/de/", "block"),
        ("http://library.test/history", "library.test", "/history", None, "allow"),
        ("http://cheap-pills-casino.test/free-bets", "cheap-pills-casino.test", "/free-bets", None, "block"),
        ("http://example.org?q", "example.org", "", None, None),
        (None, "", "", None, None), ("no scheme", "", "", None, None), ("", "", "", None, None),
    ]
    rows = [(i, u[0]) for i, u in enumerate(urls)] + [(None, "x://a.com/fr/"), (3, None)]
    got = op02_urls.judge(spark.createDataFrame(rows, "page_id bigint, url string")).collect()
    assert len(got) == len(rows)
    for (url, host, path, rule, verdict), r in zip(urls, sorted((r for r in got if r.page_id is not None and (r.page_id != 3 or r.host)), key=lambda r: r.page_id)):
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block"), url


def test_url_model_holds_out():
    table = op02_urls.TRAINING
    held = table[::4]
    weights = op02_urls.fit([t for i, t in enumerate(table) if i % 4])
    guessed = op02_urls.logits([t for t, _ in held], weights) >= 0
    assert np.mean(guessed == np.array([y for _, y in held], bool)) >= 0.75


def test_url_model_holds_out_hosts():
    import re

    def host(url):
        return re.sub(r"^(?:www|m|blog)\.|\.example\.(?:com|org|net)$", "", url.split("/")[0])

    table = op02_urls.TRAINING
    hosts = sorted({host(u) for u, _ in table})
    right = 0
    for fold in range(4):
        held = [t for t in table if host(t[0]) in hosts[fold::4]]
        rest = [t for t in table if host(t[0]) not in hosts[fold::4]]
        guessed = op02_urls.logits([t for t, _ in held], op02_urls.fit(rest)) >= 0
        right += int(sum(guessed == np.array([y for _, y in held], bool)))
    # Measured: 42 of 60. The bound was set after that, to notice if it gets worse.
    assert right >= 0.65 * len(table)


# --- 3


def test_mix_comes_near_its_targets(spark):
    rows = queries.op3_mix(spark, MIDDLE).collect()
    total = sum(r.size for r in rows)
    by = {}
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size)
        by.setdefault(r.source, []).append(r)
    assert abs(sum(rs[0].target for rs in by.values()) - 1.5 * total) < 1
    for rs in by.values():
        assert rs[0].target <= 2 * rs[0].source_size
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(r.size for r in rs)


# --- 4


def test_media_against_plain_code(spark):
    got = op04_media.media(documents(spark)).collect()
    want = {}
    for r in documents(spark).collect():
        data = (r.text or "").encode()
        padded = data.ljust(max(1, -(-len(data) // 192)) * 192, b" ")
        want.setdefault(r.doc_id, set()).add(
            (len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]), 192, len(padded) // 192)
        )
    for r in got:
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.width, r.height) in want[r.doc_id]
    assert len({(r.payload_sha256, r.media_sha256, r.media_bytes, r.feature, r.shard, r.at) for r in got}) == len(
        {r.payload_sha256 for r in got}
    )


def test_stored_form_is_lossless_and_guarded():
    payload = op04_media.payload_of("é" * 1000)
    stored = op04_media.to_png(payload)
    assert op04_media.from_png(stored) == payload
    with pytest.raises(ValueError):
        op04_media.from_png(stored[:60] + bytes([stored[60] ^ 1]) + stored[61:])
    with pytest.raises(ValueError):
        op04_media.read_header(b"x" * 33)


# --- 5


def test_toxicity_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = op05_toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    toxic = [r for r in rows if r.toxic]
    clean = [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)


def test_toxicity_locates_the_sentence(spark):
    good = [f"All is well in town {i}. The sun shines on the hill." for i in range(60)]
    bad = [f"All is well in town {i}. You are a moron. The sun shines." for i in range(60)]
    model = op05_toxicity.fit(good + bad, [0] * 60 + [1] * 60)
    docs = spark.createDataFrame([(1, bad[0]), (2, good[0]), (3, None), (4, "")], "doc_id bigint, text string")
    found = op05_toxicity.offending(docs, model).collect()
    assert {(r.doc_id, bad[0][r.start : r.end].strip()) for r in found} == {(1, "You are a moron.")}
    scores = {r.doc_id: r.score for r in op05_toxicity.scored(docs, model).collect()}
    assert scores[3] == scores[4] == 0 and scores[1] > 0.5 > scores[2]
    assert [r.doc_id for r in op05_toxicity.without_toxic(docs, model).orderBy("doc_id").collect()] == [2, 3, 4]


def test_toxicity_of_long_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = op05_toxicity.train(docs, labels)
    rows = docs.join(labels, "doc_id").where(op05_toxicity.held_out(docs.doc_id)).orderBy("doc_id")
    scored = op05_toxicity.scored(rows, model, {"toxic": "int", "text": "string"}).collect()
    clean = [r.text for r in scored if not r.toxic and not r.n_offending]
    bad = next(r.text for r in scored if r.toxic and r.score > 0.9)
    plain = "All is well in town. The sun shines on the hill. " * 21_000
    mixed = "\n".join(clean)[:1_000_000]
    assert len(mixed) == 1_000_000
    long = spark.createDataFrame([(1, plain), (2, mixed), (3, mixed + "\n" + bad)], "doc_id bigint, text string")
    assert [r.predicted for r in op05_toxicity.toxicity(long, labels.where("false")).collect()] == [0, 0, 0]
    scores = {r.doc_id: r.score for r in op05_toxicity.scored(long, model).collect()}
    assert scores[1] == 0 and scores[2] < 0.3 < 0.9 < scores[3]


def test_long_labelled_documents_are_learned_from(spark):
    rows = [(i, f"Fine town {i}. " * 6000 if i == 3 else f"Fine town {i}.", 0) for i in range(8)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    seen, fit = [], op05_toxicity.fit
    op05_toxicity.fit = lambda texts, y: seen.extend(texts) or fit(texts, y)
    try:
        op05_toxicity.train(docs, labels)
    finally:
        op05_toxicity.fit = fit
    assert sorted(seen) == sorted(t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2)
    assert max(map(len, seen)) > 50_000
    sizes = [(1, 60, 0), (2, 60, 0), (3, 5, 0), (4, 120, 1), (5, 90, 1)]
    assert op05_toxicity.pieces(sizes, 100) == [(1, 60, 0, 60), (2, 60, 0, 40), (5, 90, 1, 90)]


# --- 6


def test_words_and_ids_equal_tiktoken():
    encoding = op06_bpe.encoding(op06_bpe.RANKS)
    rng = np.random.default_rng(3)
    parts = ["a", "s", "t", "re", "ve", "ll", "d", "'", " ", "\n", "\t", "\r", "1", "²", "é", "\u00a0", "!",
             "_", "中", "😀", "\x00", "\x1c", "\x85", "\u0301", "Ⅷ", "٣", "S"]
    for _ in range(300):
        texts = ["".join(rng.choice(parts, rng.integers(0, 25))) for _ in range(4)]
        words, n = op06_bpe.words_of(texts)
        words = words.to_pylist()
        for text, stop, count in zip(texts, np.cumsum(n), n):
            own = [w.decode() for w in words[stop - count : stop]]
            assert "".join(own) == text
            ids = [i for w in own for i in encoding._encode_single_piece(w.encode())]
            assert ids == encoding.encode_ordinary(text)
            assert op06_bpe.decode(np.array(ids)) == text.encode()


def test_bpe_round_trip(spark):
    encoding = op06_bpe.encoding(op06_bpe.RANKS)
    docs = documents(spark)
    coded = op06_bpe.digests(docs, with_ids=True).collect()
    want = sorted((str(r.doc_id), encoding.encode_ordinary(r.text or "")) for r in docs.collect())
    assert sorted((str(r.doc_id), r.ids) for r in coded) == want
    for r in coded:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
    back = op06_bpe.decode_texts(op06_bpe.encode_texts(docs)).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r.doc_id), r.text or "") for r in docs.collect())


# --- 7


def test_chat_keeps_hostile_texts(spark):
    texts = ["", "<turn user>\n", "</turn>\n", "\\", "\\\\<", "a\\<turn b>\n</turn>\n", None, "\\</turn>\\", "😀>"]
    rows = [(c, t, role, texts[((c or 0) + t) % len(texts)]) for c in (1, 2, None) for t, role in
            enumerate(["system", "user", "assistant", "user", "assistant", None, "assi>st<ant\\"])]
    rows += [rows[0], (3, None, None, None)]
    conversations = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for r in op07_chat.read_back(op07_chat.format_turns(conversations)).collect():
        own = sorted(((t is not None, t or 0, role or "", x or "") for c, t, role, x in rows if c == r.conv_id))
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for *_, a, b in own).encode()).hexdigest()
        loss = "".join(b for *_, a, b in own if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_each_reply_is_an_example_with_all_turns_before(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "r1"), (1, 2, "user", "q2"), (1, 3, "assistant", "r2")]
    formatted = op07_chat.format_turns(
        spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    ).cache()
    got = {r.example: (r.context, r.target) for r in op07_chat.materialize(formatted).collect()}
    turn = "<turn {}>\n{}</turn>\n".format
    first = turn("user", "q1")
    whole = first + turn("assistant", "r1") + turn("user", "q2")
    assert got == {0: (first, turn("assistant", "r1")), 1: (whole, turn("assistant", "r2"))}
    text = whole + turn("assistant", "r2")
    spans = {text[r.loss_start : r.loss_end] for r in op07_chat.examples(formatted).collect()}
    assert spans == {"r1", "r2"}


# --- 8


def test_quality_counts_on_edges(spark):
    def counts(text):
        words = regex.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
        lines = [s for s in text.split("\n") if regex.search(r"[^\x20\x09-\x0D]", s)]
        return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))

    texts = [t for t in TEXTS if t is None or len(t) < 5000] + ["a b c d e " * 30, "x\n" * 40 + "a b c d e f a b c d e g"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in op08_quality.quality(docs).collect():
        want = counts(texts[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)


def test_quality_stays_in_the_jvm(spark):
    plan = queries.op8_quality(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_quality_keeps_good_documents(spark):
    rows = queries.op8_quality(spark, MIDDLE).join(spark.read.parquet(f"{MIDDLE}/labels.parquet"), "doc_id")
    good = rows.where("quality = 1 AND NOT base_failed").collect()
    assert sum(r.kept for r in good) >= 0.95 * len(good)


# --- 9


EMAIL = regex.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = regex.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = regex.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = regex.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern in ((2, CARD), (3, PHONE)):
        for m in pattern.finditer(text):
            digits = regex.sub("[^0-9]", "", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(4)
    parts = list("0123456789.+-() @ab%_\n") + ["4111 1111 1111 1111", "+1 (663) 555-6869"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(0, 30)))
        assert op09_pii.base_spans(text) == plain_spans(text), text


def test_field_on_held_out_sequences_and_shortcut():
    field = op09_pii.fit(op09_pii.labelled_table())
    held = op09_pii.labelled_table(150, seed=11)
    wrong = total = 0
    for words, labels in held:
        points, starts = op09_pii.code_points([w + " " for w in words])
        x = op09_pii.shapes(points, starts[:-1], starts[1:] - 1)
        begins = np.arange(len(words)) == 0
        got = op09_pii.viterbi(op09_pii.emissions(x, begins, field), np.array([0]), np.array([len(words)]), field.pairs)
        wrong, total = wrong + int((got != labels).sum()), total + len(labels)
    assert wrong <= 0.02 * total
    texts = [" ".join(w) for w, _ in held] + ["plain words only, And more!\nYes."] + [t or "" for t in TEXTS]
    assert op09_pii.field_spans(texts, field) == op09_pii.field_spans(texts, field._replace(plain_is_none=False))
    assert op09_pii.field_spans(["number 9807915762804490 it is"], field) == [[(7, 2, 23)]]
    assert op09_pii.field_spans(["version 3.0, of 2021, CC BY-NC 4.0."], field) == [[]]


def test_pii_rows_and_redaction(spark):
    docs = documents(spark, clash=False)
    for r in op09_pii.find_personal(docs.where("doc_id IS NOT NULL")).collect():
        base = plain_spans(TEXTS[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        text = ",".join(f"{op09_pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert all(s in r.spans.split(",") for s in text.split(",") if s)
    clean = op09_pii.redacted(docs)
    assert clean.columns == docs.columns
    found = {r.doc_id: r.text for r in clean.where("doc_id IS NOT NULL").collect()}
    assert found[8].startswith("[EMAIL] and [IP], [PHONE] [CARD]") and found[0] is None and found[6] == LONG


# --- 10


def brute_classes(rows):
    """doc number -> set of doc numbers, by comparing all pairs of different texts."""
    from collections import Counter

    def units(text):
        words = regex.findall(r"[^\W_]+", (text or "").lower())
        return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()

    texts = sorted({t or "" for _, t in rows})
    bags = [units(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = (bags[i] & bags[j]).total()
            either = bags[i].total() + bags[j].total() - both
            if either and both >= 0.8 * either:
                parent[root(i)] = root(j)
    least = {}
    for doc, text in rows:
        least.setdefault(root(texts.index(text or "")), []).append(doc)
    return {(doc, text): min((d for d in least[root(texts.index(text or ""))] if d is not None), default=None) for doc, text in rows}


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(400)]
    rows, base = [], [str(w) for w in rng.choice(words, 120)]
    for i in range(120):  # one chain of copies, each with some words changed
        text = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 9)):
            text[at] = str(rng.choice(words))
        rows.append((i, " ".join(text)))
        if i % 40 == 39:
            base = [str(w) for w in rng.choice(words, 120)]
    rows += [(500 + i, t) for i, t in enumerate(TEXTS)] + [(7, rows[3][1]), (None, rows[5][1]), (None, "only one here")]
    rows += [rows[0]] * 3
    want = brute_classes(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = op10_dartminhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by_id = {}
    for (doc, _), c in want.items():
        by_id.setdefault(doc, set()).add(c)
    for r in got:
        assert r.class_id in by_id[r.doc_id]
    kept = op10_dartminhash.one_of_each_class(docs).collect()
    assert sorted(map(str, (want[(r.doc_id, r.text)] for r in kept))) == sorted(map(str, set(want.values())))


def test_signatures_agree_as_often_as_texts_are_alike():
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(5000)]
    base = [str(w) for w in rng.choice(words, 400)]
    other = base[:300] + [str(w) for w in rng.choice(words, 100)]
    texts = [" ".join(base), " ".join(other), " ".join(base + base)]
    units, owner = op10_dartminhash.elements(texts)
    sig = op10_dartminhash.signatures(units, owner, 3)
    for i, j in ((0, 1), (0, 2)):
        a, b = set(units[owner == i].tolist()), set(units[owner == j].tolist())
        assert abs(np.mean(sig[i] == sig[j]) - len(a & b) / len(a | b)) < 0.12


def test_components_of_a_long_path(spark):
    n = 40
    labels = spark.range(n).selectExpr("id AS node", "id AS label")
    edges = spark.range(n - 1).where("id <> 20").selectExpr("id AS a", "id + 1 AS b")
    got = {r.node: r.label for r in op10_dartminhash.components(labels, edges).collect()}
    assert got == {i: 0 if i <= 20 else 21 for i in range(n)}


# --- the pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = op10_dartminhash.durable(stage(spark, docs, SMALL))
        if name != "bpe":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
        if name in ("toxicity", "near_duplicates"):
            assert docs.exceptAll(before).isEmpty() and 0 < docs.count() < before.count()
        if name == "near_duplicates":
            classes = op10_dartminhash.near_duplicates(before).select("class_id").distinct()
            assert docs.count() == classes.count()
        if name == "pii":
            assert docs.count() == before.count()
            assert op09_pii.find_personal(docs).where("n_email + n_ip + n_card + n_phone > 0").isEmpty()
        if name == "mix":
            taken = op03_mix.mix_sources(before).where("copies > 0").selectExpr("doc_id", "copies")
            assert {(r.doc_id, r["count"]) for r in docs.groupBy("doc_id").count().collect()} == {tuple(r) for r in taken.collect()}
        if name == "bpe":
            texts = {r.doc_id: r.text for r in before.collect()}
            encoding = op06_bpe.encoding(op06_bpe.RANKS)
            assert docs.count() == before.count()
            for r in docs.collect():
                ids = np.array(encoding.encode_ordinary(texts[r.doc_id]), "<u4")
                assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
                assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_pipeline_returns_the_ids(spark):
    docs = documents(spark, clash=False)
    encoding = op06_bpe.encoding(op06_bpe.RANKS)
    got = dict(corpus_pipeline.STAGES)["bpe"](spark, docs, SMALL)
    assert dict(got.dtypes)["ids"] == "array<int>"
    want = sorted((str(r.doc_id), encoding.encode_ordinary(r.text or "")) for r in docs.collect())
    assert sorted((str(r.doc_id), r.ids) for r in got.collect()) == want
