"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Blocks in menus, headers, footers, sidebars,
forms, adverts, notices and comments (by tag, role, class or id) are left out. The first pass
classifies the rest alone, by stop-word density, length and link density: good, near-good, bad
or short. An element is not left out for its name or as a form if an article or main element is inside it. The second pass settles the ambiguous ones by the nearest decided neighbours: a short block needs good ones,
a near-good block is refused between two bad ones. Inside an ``article`` or ``main`` element the
markup has already said what the text is: there no block is refused for few stop words, many links
or its length. On a page whose long blocks hold few of the known stop words, its language is another,
and length and link density decide alone.

Character references are decoded, white space inside a block becomes one space. Null html is
empty; pages without text have an empty one. Broken markup is read as browsers do in the main:
unclosed paragraphs end where the next block begins, an unfinished tag at the end is dropped. A page
takes time in proportion to its length, also with many tags that are never closed or never opened.
Repeated rows are extracted each for itself, an empty table gives an empty result, extra columns
are passed through (one named like the result gives way).
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from panelweave.llm.registry import query, table, with_columns

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template textarea title iframe svg select xmp noembed noframes".split())
LEFT_OUT_TAGS = frozenset("nav header footer aside form menu dialog button label head".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
LEFT_OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidebars aside menu nav navbar navigation "
    "breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices alert popup modal overlay comment comments "
    "reply replies disqus discussion share sharing social related recommended newsletter subscribe subscription signup login search widget "
    "pagination pager toolbar disclaimer copyright".split())
#: A name with one of these says that the page has the thing or does not, not that the element is it.
MODIFIERS = frozenset("has have no not non with without is show shows hide hides free supports supported enabled disabled".split())
#: Pieces behind a name that leave its meaning: ad-slot, sidebar-left, comment-list, social-links.
PLAIN_ENDINGS = frozenset(
    "left right top bottom inner outer upper lower primary secondary mobile desktop sticky fixed wrapper wrap container holder box block "
    "panel section area region zone slot unit frame row col column list items item link links button buttons btn icon icons bar bars "
    "form field input text body content message author meta title label group posts post articles stories toggle dropdown".split())
HEADING_TAGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
HEADER_NAMES = frozenset(("header", "masthead"))
MAIN_TAGS = frozenset(("article", "main"))

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """a about after all also an and any are as at be been but by can could did do for from had has have he her his how i if in into is
    it its more no not of on one only or other our out she so some than that the their them then there these they this to up was we
    were what when which who will with would you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die doch ein eine einem einen einer er es für hat ich ihr im ist
    ja kann man mit nach nicht noch nur oder sein sich sie sind so über um und uns vom von vor war was wenn wie wir wird zu zum zur
    au aux avec ce ces cette dans de des du elle en est et être il ils je la le les leur lui mais ne nous on ou où par pas plus pour
    que qui sa sans se ses son sont sur tout très un une vous
    al como con de del desde el ella en entre era es esta este esto fue ha hasta la las lo los más me mi muy no nos o para pero por
    porque que se ser si sin sobre son su sus también tan todo un una uno y ya""".split())

OPEN, SHUT = 1, 2
SHORT, LONG = 40, 120  # characters
DENSE, SPARSE, LINKED = 0.30, 0.15, 0.33  # stop-word densities of good and near-good text, link density of bad text

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^<>]*\Z""", re.S)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    main: int  # number of the enclosing article or main element, 0 if there is none
    label: str = ""


def _named_out(value: str, names: frozenset) -> bool:
    """Whether one of the blank-separated names is, or ends in, a name of what is left out: 'reader-comments', not 'share-price'."""
    for name in value.split():
        pieces = [p for p in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if p]
        if not MODIFIERS.isdisjoint(pieces):
            continue
        while len(pieces) > 1 and pieces[-1] not in names and (pieces[-1] in PLAIN_ENDINGS or len(pieces[-1]) == 1):
            pieces.pop()
        if pieces and pieces[-1] in names:
            return True
    return False


def _left_out(tag: str, attributes: str, main: bool) -> int:
    """0: kept, OPEN: left out unless it holds an article or main element, SHUT: left out. ``main``: inside such an element."""
    if tag in LEFT_OUT_TAGS:
        return OPEN if tag == "form" else SHUT
    if tag in ("html", "body", "article", "main"):
        return 0
    names = LEFT_OUT_NAMES - HEADER_NAMES if main or tag in HEADING_TAGS else LEFT_OUT_NAMES
    for name, value in _NAMED.findall(attributes):
        role = name.lower() == "role"
        if not LEFT_OUT_ROLES.isdisjoint(value.strip("\"'").lower().split()) if role else _named_out(value.strip("\"'"), names):
            return OPEN
    return 0


def blocks(page: str) -> list[Block]:
    """The blocks of a page that are not left out by tag, role, class or id."""
    out: list[Block] = []
    stack: list[tuple[str, tuple, int]] = []  # open elements: tag, by what it is left out (elements by number, linked lists), number of main element
    pieces: list[tuple[str, bool, tuple]] = []
    held: list[tuple[list, int]] = []  # pieces and main element of each block
    holding: set[int] = set()  # elements that hold an article or main element
    opened: Counter[str] = Counter()  # open elements by tag, so that an end tag without one is no walk
    at_tag: defaultdict[str, list[int]] = defaultdict(list)  # places in the stack by tag; those that are gone are dropped when met
    borders: list[int] = []  # places of open block elements other than p
    solid: list[int] = []  # places of all open block elements
    mains = links = breaks = at = elements = 0

    def close() -> None:
        if pieces:
            held.append((pieces.copy(), stack[-1][2] if stack else 0))
        pieces.clear()

    def is_out(causes: tuple) -> bool:
        while causes:
            number, causes = causes
            if number not in holding:
                return True
        return False

    def pop_to(n: int) -> None:
        nonlocal links
        for t, _, _ in stack[n:]:
            links -= t == "a"
            opened[t] -= 1
        for places in (borders, solid):
            while places and places[-1] >= n:
                places.pop()
        del stack[n:]

    def add(raw: str) -> None:
        if raw:
            pieces.append((raw, links > 0, stack[-1][1] if stack else ()))

    while (m := _TAG.search(page, at)) is not None:
        add(page[at:m.start()])
        if m.end() > m.start() and page[at:m.start()].strip():
            breaks = 0
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if tag in RAW_TAGS:
            if not m[1] and not m[3].endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            breaks += 1
            close() if breaks > 1 else pieces.append((" ", False, ()))
            continue
        if tag in BLOCK_TAGS:
            close()
            breaks = 0
        if m[1]:
            border = borders[-1] if borders and tag not in BLOCK_TAGS else -1  # an inline end tag closes nothing outside its block
            places = at_tag[tag]
            while places and (places[-1] >= len(stack) or stack[places[-1]][0] != tag):
                places.pop()
            if opened[tag] and places and places[-1] > border:
                pop_to(places.pop())
            continue
        if tag in VOID_TAGS:
            continue
        if tag in BLOCK_TAGS:
            # a new block ends an open paragraph, a new item an open item; both are the innermost block if anything
            if solid and (stack[solid[-1]][0] == "p" or (tag == stack[solid[-1]][0] and tag in ("li", "dt", "dd", "tr", "td", "th", "option"))):
                pop_to(solid[-1])
        inner = stack[-1] if stack else ("", (), 0)
        if tag in MAIN_TAGS and not inner[2]:
            mains += 1
            inner = (inner[0], inner[1], mains)
            if not any(name.lower() != "role" and _named_out(value.strip("\"'"), LEFT_OUT_NAMES) for name, value in _NAMED.findall(m[3])):
                causes = inner[1]
                while causes and causes[0] > 0:  # those of SHUT elements are negative, and come first
                    number, causes = causes
                    holding.add(number)
        causes, why = inner[1], _left_out(tag, m[3], inner[2] > 0)
        if why and not (causes and causes[0] < 0):
            elements += 1
            causes = (elements if why == OPEN else -elements, causes)
        at_tag[tag].append(len(stack))
        if tag in BLOCK_TAGS:
            solid.append(len(stack))
            if tag != "p":
                borders.append(len(stack))
        stack.append((tag, causes, inner[2]))
        opened[tag] += 1
        links += tag == "a"
    add(page[at:])
    close()
    for parts, main in held:
        left = [(entities.unescape(t), inside) for t, inside, causes in parts if not is_out(causes)]
        text = " ".join("".join(t for t, _ in left).split())
        if text:
            out.append(Block(text, sum(len("".join(t.split())) for t, inside in left if inside), main))
    return out


def _stops(text: str) -> tuple[int, int]:
    """(stop words, words)."""
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words), len(words)


def _linked(block: Block) -> bool:
    return block.linked > LINKED * len(block.text.replace(" ", ""))


def known_language(found: list[Block]) -> bool:
    """Whether the stop words are those of the page: its long blocks of little link text hold enough of them, or there are none."""
    counts = [_stops(b.text) for b in found if not b.main and len(b.text) > LONG and not _linked(b)]
    return sum(s for s, _ in counts) >= SPARSE * sum(w for _, w in counts)


def first_pass(block: Block, known: bool = True) -> str:
    """good, near, short or bad. ``known``: the stop words are of the page's language; else length and links alone decide."""
    if not block.main and (_linked(block) or "©" in block.text):
        return "bad"
    if len(block.text) < SHORT:
        return "short"
    stops, words = _stops(block.text)
    density = stops / words if words else 0.0
    if density >= DENSE or block.main or not known:
        return "good" if len(block.text) > LONG else "near"
    return "near" if density >= SPARSE else "bad"


def second_pass(found: list[Block]) -> None:
    """Settle short and near-good blocks by the nearest decided ones; within a main element only those of it count."""
    n = len(found)
    decided = [b.label if b.label in ("good", "bad") else "" for b in found]
    before, after = [""] * n, [""] * n
    for i in range(1, n):
        if found[i].main == found[i - 1].main:
            before[i] = decided[i - 1] or before[i - 1]
    for i in range(n - 2, -1, -1):
        if found[i].main == found[i + 1].main:
            after[i] = decided[i + 1] or after[i + 1]
    for i, block in enumerate(found):
        if not decided[i]:
            sides = {before[i], after[i]} - {""}
            if block.main or block.label == "near":
                block.label = "bad" if before[i] == after[i] == "bad" and not (block.main and block.label == "near") else "good"
            else:
                block.label = "good" if sides == {"good"} else "bad"


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    known = known_language(found)
    for block in found:
        block.label = first_pass(block, known)
    second_pass(found)
    return "\n".join(b.text for b in found if b.label == "good")


@F.pandas_udf(StringType())
def _main_texts(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None)


def extract_main_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """The input with the main text of each page. One pass without a shuffle; only the html goes to Python."""
    done = pages.withColumn("_main", _main_texts(F.col(html)))
    return with_columns(done, {out: F.col("_main")}).drop("_main")


@query("op9_html_text")
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page and its length."""
    found = extract_main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
