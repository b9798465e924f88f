"""op1 on ordinary but careless markup, and how its time and that of op9 grow with one row."""

import time

import pytest
from millrace.llm import op01_html, op09_pii

BODY = "<p>One two, three.</p>"


@pytest.mark.parametrize(
    "page, text",
    [
        ('<article><p>See <a href="/hidden-valley">the valley</a>, too.</p></article>', "See the valley, too."),
        ('<article><p title="hidden gems">Some text, here.</p></article>', "Some text, here."),
        (f'<article><div data-class="ad">{BODY}</div></article>', "One two, three."),
        (f"<article><p data-x=it's>Some text, here.</p>{BODY}</article>", "Some text, here. One two, three."),
        (f'<article><img alt="5" tall">{BODY}</article>', "One two, three."),
        (f'<body><form action="/x" method="post"><article>{BODY}</article></form></body>', "One two, three."),
        (f"<article>{BODY}<form><p>Your name, please</p><input name=a></form></article>", "One two, three."),
        (f"<article>{BODY}<div class=ad>Buy, now</div></article>", "One two, three."),
        (f"<article>{BODY}<div CLASS = 'ad'>Buy, now</div></article>", "One two, three."),
    ],
)
def test_attributes_are_read_one_by_one(page, text):
    assert op01_html.main_text(page) == text


@pytest.mark.parametrize(
    "page",
    [
        "<i><article>" + "<b>x " * 100_000 + "</i>" * 200_000,
        "<article>" + "<div>" * 200_000 + "x, y",
        "<article>" + "</p>" * 200_000 + "x, y",
        "<article>" + "<a href='" * 100_000,
        "<article>" + "<p a" * 200_000,
        "<article>x" + "<!--" * 200_000,
    ],
)
def test_time_in_proportion_to_the_page(page):
    began = time.process_time()
    op01_html.main_text(page)
    assert time.process_time() - began < 5


def test_added_spans_are_those_apart_from_base_spans():
    base = [(0, 2, 30), (5, 1, 9), (40, 0, 44), (44, 3, 50), (70, 1, 75)]
    more = [(10, 2, 12), (29, 2, 31), (30, 3, 40), (50, 2, 60), (60, 2, 71), (75, 0, 80), (39, 1, 41)]
    plain = [a for a in more if not any(s < a[2] and a[0] < e for s, _, e in base)]
    assert op09_pii.apart_from(base, more) == plain == [(30, 3, 40), (50, 2, 60), (75, 0, 80)]
    assert op09_pii.apart_from([], more) == more and op09_pii.apart_from(base, []) == []


def test_many_spans_in_one_text():
    field = op09_pii.fit(op09_pii.labelled_table())
    text = "from 10.2.3.4 card 9807915762804490 it is\n" * 50_000
    began = time.process_time()
    ((base, spans),) = op09_pii.find([text], field)
    assert time.process_time() - began < 60
    assert len(base) == 50_000 and len(spans) == 100_000
