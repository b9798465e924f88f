"""Main-text extraction by tree scoring.

A page is read once into a tree of elements and text blocks. Every block passes points for its
length and commas to its ancestors (all to the nearest, half to the next, then less), discounted
by the share of its characters that are link text. The container with the most points and those
of its siblings that score near it, or are headings, are kept; a container inside an <article>
stands for the outermost such article, whose siblings are kept by the same rule. Elements that are no article text by tag, role or class (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, reader comments) are left out
before scoring; a form around the article itself is only a wrapper. Tags and attributes are read
by the rules of HTML, in time proportional to the page.

Each page is extracted by itself: no shuffle, memory bounded by the longest page.

Cases: null or empty html, or html without text, gives the empty text; html that breaks off in
a tag, comment, script or character reference is read as far as it goes; text without any tag is
one block; repeated rows give equal texts; an empty table gives no rows. Only page_id, url and
html are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pick

# One attribute: a name, then perhaps a value. Only right after = does a quote open a value.
_ATTRIBUTE = re.compile(
    r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+|(?=>|\Z)))?+"""
)
_UNNAMED = _ATTRIBUTE.pattern.replace("([^\\s/>]", "(?:[^\\s/>]").replace('("[^"]*+', '(?:"[^"]*+')
_MARKUP = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))"""
    r"""|<[!?][^>]*+(?:>|\Z)"""
    rf"""|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<attrs>(?:[\s/]++|{_UNNAMED})*+)(?:>|\Z)"""
    r"""|</[^>]*+(?:>|\Z)""",
    re.DOTALL,
)
_READ = frozenset("class id role style hidden aria-hidden".split())

RAW = frozenset("script style noscript iframe noembed noframes title textarea".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
DROPPED = frozenset(
    "nav footer aside button select datalist svg canvas object audio video template "
    "dialog menu head applet map fieldset".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter "
    "nobr output progress q ruby rb rp rt s samp small span strike strong sub sup time tt u var "
    "wbr input "
    # Formulas: math and what it holds.
    "math mrow mi mn mo ms mtext mspace mfrac msqrt mroot msub msup msubsup munder mover munderover "
    "mmultiscripts mprescripts none mtable mtr mtd mstyle mpadded mphantom merror semantics "
    "annotation annotation-xml".split()
)
# An open p ends where any element starts that is not inline; these end their like, too.
ENDS_LIKE = {
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}),
    "th": frozenset({"td", "th"}),
    "option": frozenset({"option"}),
}
SCOPES = frozenset("ul ol dl table article section div main body html".split())
# What the start of an element ends lies inside these.
STOPS = SCOPES | DROPPED | {"header", "form"}

_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar "
    "form toolbar".split()
)
# Whole names of a class or id. A name of several words (site-nav, ad_slot_2) is unwanted if each
# of its words is, or says only what kind of box it is; one with other words is not.
_UNWANTED = re.compile(
    r"(?:ad|ads|adv|adbox|adslot|adunit|advert\w*|sponsor\w*|promo\w*|banner\w*|nav|navbar\w*|navigation|menu\w*|"
    r"breadcrumb\w*|sidebar\w*|sidenav|aside|footer|siteheader|masthead|topbar|toolbar|cookie\w*|consent|gdpr|notice\w*|"
    r"popup\w*|modal|overlay|newsletter\w*|subscribe\w*|subscription|signup|login|share|sharing|"
    r"social\w*|related\w*|recommend\w*|outbrain|taboola|pagination|pager|widget\w*|"
    r"search|searchbox|skip|hidden|disclaimer|alert)\Z"
)
_COMMENTS = re.compile(r"(?:comment\w*|disqus\w*|respond|replies|reply|discussion)\Z")
_WANTED = re.compile(r"(?:article|content|main|story|post|entry|text|body)\Z")
_BOX = re.compile(
    r"(?:area|bar|block|box|btns?|buttons?|container|form|group|holder|icons?|inner|item|items|left|"
    r"links?|list|lists|module|outer|page|panel|posts|articles|stories|primary|right|row|secondary|"
    r"section|site|slot|thread|top|bottom|unit|wrap|wrapper|global|header|[0-9]+)\Z"
)
# Parts of a page's text are often named after what they are about: no id of these is judged, and
# of other elements not these ids.
_TEXT = re.compile(r"(?:h[1-6]|p|pre|blockquote)\Z")
_TOPICS = re.compile(
    r"(?:discussion|related|search|share|sharing|alert|notice\w*|disclaimer|navigation|subscription|"
    r"consent|respond|reply|replies|recommend\w*|social\w*|advert\w*)\Z"
)
_SAYS_HOW = re.compile(r"(?:no|has|with|without)[-_]")
_HEADING = re.compile(r"h[1-6]\Z")

# Scoring: points at most for length, characters a point, bonus of wanted containers, and what
# share of the best score a sibling needs.
MOST_LENGTH_POINTS, CHARS_A_POINT, BONUS, SIBLING_SHARE, LEVELS = 3.0, 100, 0.25, 0.2, 5


class Node:
    __slots__ = ("bonus", "dropped", "form", "holder", "links", "parent", "points", "size", "tag", "where")

    def __init__(
        self, tag: str, parent: Node | None, bonus: float, where: int, dropped: bool = False
    ) -> None:
        self.tag, self.parent, self.bonus, self.where = tag, parent, bonus, where
        self.dropped = dropped  # left out, or inside an element that is
        self.points = 0.0
        self.size = self.links = 0
        # The nearest element that is not inline, and the outermost form, from this one upwards.
        self.holder: Node = parent.holder if parent is not None and tag in INLINE else self
        self.form: Node | None = parent.form if parent is not None else None
        if self.form is None and tag == "form":
            self.form = self


def _attributes(attrs: str) -> dict[str, str]:
    """The attributes that are judged, in lower case; of equal names the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attrs):
        name = m[1].lower()
        if name in _READ:
            value = m[2] or ""
            quoted = value[:1] in ("'", '"')
            found.setdefault(name, (value[1:-1] if quoted and value[-1] == value[0] and len(value) > 1 else value.lstrip("\"'")).lower())
    return found


def _closes_itself(attrs: str) -> bool:
    """Whether the tag ends in a slash that belongs to no attribute."""
    if not attrs.endswith("/"):
        return False
    last = 0
    for m in _ATTRIBUTE.finditer(attrs):
        last = m.end()
    return last < len(attrs)


def _look(tag: str, attrs: str, in_article: bool) -> tuple[bool, float]:
    """Whether the element is left out, and its bonus as a container."""
    if tag in DROPPED or tag == "header" and not in_article:
        return True, 0.0
    bonus = BONUS if tag in ("article", "main") else 0.0
    if not attrs or tag in ("html", "body"):
        return False, bonus
    found = _attributes(attrs)
    if not found:
        return False, bonus
    if "hidden" in found or found.get("aria-hidden") == "true":
        return True, 0.0
    if found.get("role") in _ROLES or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True, 0.0
    classes, ids = found.get("class", "").split(), found.get("id", "").split()
    if tag in ("article", "main") or any(_wanted(n) for n in (*classes, *ids)):
        return False, BONUS
    names = classes
    if not _TEXT.match(tag):
        names = classes + [n for n in ids if not _TOPICS.match(n)]
    if any(_unwanted(n) or n == "header" and not in_article for n in names):
        return True, 0.0
    return False, bonus


def _wanted(name: str) -> bool:
    """Whether it names a container of text, such as content or post-body."""
    return all(_WANTED.match(w) for w in re.split(r"[-_]+", name))


def _unwanted(name: str) -> bool:
    """Whether it names what is no article text, such as ad, comment-list or site-header."""
    if _SAYS_HOW.match(name):
        return False
    words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
    bad = [bool(_UNWANTED.match(w) or _COMMENTS.match(w)) for w in words]
    # post-comments, article-share: what belongs to the article, but is not its text.
    rest = words[1:] if len(words) > 1 and _WANTED.match(words[0]) else words
    if "header" in words and len(words) > 1 and words[0] in ("site", "page", "global"):
        return True
    return any(bad) and all(b or _BOX.match(w) for w, b in zip(words[-len(rest) :], bad[-len(rest) :]))


def parse(page: str) -> tuple[list[Node], list[tuple[str, int, Node]]]:
    """Elements in page order, and text blocks with their link characters and element."""
    root = Node("#root", None, 0.0, 0)
    nodes, blocks = [root], []
    stack: list[Node] = [root]
    # Where in the stack the open elements of each tag, and those of SCOPES and STOPS, are.
    open_: dict[str, list[int]] = {}
    scopes: list[int] = []
    stops: list[int] = []
    pieces: list[tuple[str, bool]] = []

    def flush() -> None:
        if pieces:
            text = " ".join("".join(t for t, _ in pieces).split())
            if text:
                links = sum(len("".join(t.split())) for t, linked in pieces if linked)
                blocks.append((text, min(links, len(text)), stack[-1].holder))
            pieces.clear()

    def push(node: Node) -> None:
        open_.setdefault(node.tag, []).append(len(stack))
        if node.tag in STOPS:
            stops.append(len(stack))
            if node.tag in SCOPES:
                scopes.append(len(stack))
        stack.append(node)

    def end_from(i: int) -> None:
        """Ends the element at i of the stack and all inside it."""
        while len(stack) > i:
            tag = stack.pop().tag
            open_[tag].pop()
            if tag in STOPS:
                stops.pop()
                if tag in SCOPES:
                    scopes.pop()

    def last(of: list[int] | None) -> int:
        return of[-1] if of else 0

    def close(tags: frozenset[str], stop: list[int]) -> None:
        """Ends the nearest open element of tags, and all inside it, unless a stop is nearer."""
        i = max(last(open_.get(t)) for t in tags)
        if i and i >= last(stop):
            end_from(i)

    def close_dropped(tag: str) -> bool:
        """Ends the nearest open tag among what is left out; True if that, or nothing, is to end.

        The end of a block around what is left out ends both, that of an inline element does not.
        """
        if not stack[-1].dropped:
            return False
        i = last(open_.get(tag))
        if i and stack[i].dropped:
            end_from(i)
            return True
        return tag in INLINE

    at, end = 0, len(page)
    for_raw: dict[str, re.Pattern] = {}
    while at < end:
        m = _MARKUP.search(page, at)
        text = page[at : m.start() if m else end]
        if text and not stack[-1].dropped:
            pieces.append((html.unescape(text) if "&" in text else text, bool(open_.get("a"))))
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if not m.group(0).endswith(">"):
            break  # the page ends inside a tag
        if (tag in RAW or tag == "xmp") and not m["end"]:
            if tag not in for_raw:
                for_raw[tag] = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.IGNORECASE)
            closing = for_raw[tag].search(page, at)
            if tag == "xmp":  # text as it stands
                if open_.get("p"):
                    flush()
                    close(frozenset({"p"}), stops)
                flush()
                if not stack[-1].dropped:
                    pieces.append((page[at : closing.start() if closing else end], False))
                flush()
            at = closing.end() if closing else end
            continue
        if tag == "br" or tag == "hr":
            flush()
            continue
        if tag in VOID:
            if tag not in INLINE:
                flush()
            continue
        if m["end"]:
            if close_dropped(tag):
                continue
            if tag in INLINE:
                close(frozenset({tag}), scopes)
            else:
                flush()
                close(frozenset({tag}), [] if tag in SCOPES or tag == "form" else scopes)
            continue
        if tag not in INLINE:
            flush()
            if open_.get("p"):
                close(frozenset({"p"}), stops)
            if tag in ENDS_LIKE:
                close(ENDS_LIKE[tag], stops)
        inside = bool(open_.get("article") or open_.get("main"))
        within = stack[-1].dropped
        out, bonus = (True, 0.0) if within else _look(tag, m["attrs"], inside)
        if (tag in DROPPED or stack[-1].dropped) and _closes_itself(m["attrs"]):
            continue
        if out:
            flush()
        node = Node(tag, stack[-1], bonus, len(nodes), out)
        if not out:
            nodes.append(node)
        push(node)
    flush()
    return nodes, without_forms(nodes, blocks)


Block = tuple[str, int, Node]


def without_forms(nodes: list[Node], blocks: list[Block]) -> list[Block]:
    """The blocks without those in forms, but for a form that is put around the text itself.

    That is a form, not inside an article or main, that holds one, or whose paragraphs have more
    text than all that stands outside of it.
    """
    forms = {n.form.where: n.form for n in nodes if n.form is not None}
    if not forms:
        return blocks
    around: set[int] = set()
    inside = dict.fromkeys(forms, 0)
    paragraphs = dict.fromkeys(forms, 0)
    total = 0
    for n in nodes:
        if n.form is not None and n.tag in ("article", "main"):
            around.add(n.form.where)
    for text, links, node in blocks:
        total += len(text) - links
        if node.form is not None:
            inside[node.form.where] += len(text) - links
            if node.tag in ("p", "pre", "blockquote"):
                paragraphs[node.form.where] += len(text) - links
    for where, form in forms.items():
        if paragraphs[where] > total - inside[where]:
            around.add(where)
        up = form.parent
        while up is not None:
            if up.tag in ("article", "main"):
                around.discard(where)
            up = up.parent
    return [b for b in blocks if b[2].form is None or b[2].form.where in around]


def main_text(page: str | None) -> str:
    """The article's text of one page."""
    if not page:
        return ""
    nodes, blocks = parse(page)
    if not blocks:
        return ""
    for text, links, node in blocks:
        paid = (1 + text.count(",") + min(len(text) / CHARS_A_POINT, MOST_LENGTH_POINTS)) * (
            1 - links / len(text)
        )
        own, to, level = node, node.parent.holder if node.parent else node, 0
        if own.tag in ("div", "article", "main", "section", "body", "#root", "blockquote", "form"):
            to = own  # text that stands in a container without a paragraph of its own
        while to is not None and level < LEVELS:
            to.points += paid / (level + 1 if level < 2 else 3 * level)
            to, level = to.parent.holder if to.parent else None, level + 1
        own.size += len(text)
        own.links += links
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.size += node.size
            node.parent.links += node.links

    def score(n: Node) -> float:
        return n.points * (1 + n.bonus) * (1 - n.links / n.size) if n.size else 0.0

    best = max(nodes, key=score)  # the first of equals
    up = best
    while up is not None:  # the outermost article
        best = up if up.tag == "article" else best
        up = up.parent
    kept, least = {best.where}, SIBLING_SHARE * score(best)
    if best.parent is not None:
        for n in nodes:
            if n.parent is best.parent and n.size:
                if score(n) >= least > 0 or _HEADING.match(n.tag) or n.tag in ("header", "hgroup"):
                    kept.add(n.where)
                elif n.tag in ("p", "pre", "blockquote") and n.links * 2 < n.size:
                    kept.add(n.where)
    within = [False] * len(nodes)
    for n in nodes:  # parents come before their children
        within[n.where] = n.where in kept or n.parent is not None and within[n.parent.where]
    return " ".join(text for text, _, node in blocks if within[node.where])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [main_text(p.as_py()) for p in part["html"]]
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array(texts, pa.string())],
                    names=["page_id", "url", "text"],
                )

    found = pick(pages, "page_id", "url", "html").mapInArrow(
        run, "page_id bigint, url string, text string"
    )
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
