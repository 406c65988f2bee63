"""Main text of web pages: block rules in two passes.

A page is cut into blocks at block-level tags. First pass: blocks in menus, headers,
footers, sidebars, forms, notices, adverts and comments (by element, role, class or id) are
boilerplate; blocks of an article or main element are text; any other is judged by its
link density, length and stop-word density. A main element is text wherever it stands but
among comments, an article also inside menus, forms and layout names; a form that holds most
of a page is no form of it. Short blocks stay undecided. Second pass: each of these takes the label of its nearest decided neighbours: where both agree, theirs; else
that of the nearer, and of text where both are as near.

Defined results: a null or empty page, and one without a block of text, has empty text;
markup that breaks off is read as far as it goes; pages are judged one by one, whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfcast.llm.quality_rules import STOP_WORDS

SHORT = 70
LONG = 200
MOST_LINKS = 0.33
FEW_STOP_WORDS = 0.12
MANY_STOP_WORDS = 0.25

# Elements and names of the HTML vocabulary and of common page layouts.
SILENT = set("head script style noscript template iframe svg math object canvas select option textarea button title".split())
RAW = set("script style textarea title noscript iframe".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
BOILERPLATE = set("nav footer aside form menu dialog header".split())
ASIDE = set("footer aside".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
CONTENT = set("article main".split())
HINTS = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe signup login menu nav navbar navigation breadcrumb "
    "breadcrumbs sidebar aside footer header masthead comment comments disqus reply replies respond related share sharing "
    "social widget toolbar pagination pager copyright disclaimer skip".split()
)
# Of these, also the articles inside are boilerplate: teasers are articles too.
LISTED = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies newsletter nav navbar "
    "navigation menu aside sidebar related widget".split()
)
# Of these, also the main elements inside.
REMARKS = set("comment comments disqus reply replies respond".split())
# As a part of a longer name these say little: `menu-open`, `elementor-widget`, `related-work`.
VAGUE = set("nav navbar navigation menu widget".split())
# `has-header` and `with-sidebar` tell what a page has beside its text.
MODIFIERS = set("has have with without no not hide show".split())
IN_HEAD = set("base link meta title style script noscript template".split())
FOREIGN = set("svg math object".split())
_STOP = {w for ws in STOP_WORDS.values() for w in ws.split()}
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^"'>]|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))""",
    re.S,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_WORD = re.compile(r"[^\W\d_]+")

TEXT, BOILER, OPEN = "text", "boilerplate", None
# Other places. Boilerplate, but for a main element inside; and for an article inside.
COMMENTS, WRAPPER, FORM = "comments", "wrapper", "form"
# Boilerplate unless it reads like text; related matter; a part of an article that may be.
DOUBTFUL, RELATED, JUDGED = "doubtful", "related", "judged"


@dataclass
class Piece:
    """A block: its text, the characters of it inside links, and where it stands."""

    text: str
    linked: int
    place: str | None
    heading: bool


def _hinted(name: str, rest: str) -> str | None:
    """The place that role, class and id tell of; the strongest of several."""
    if name in ("html", "body") or "=" not in rest:
        return None
    said = set()
    for kind, value in _NAMED.findall(rest):
        value = value.strip("\"'")
        if kind.lower() == "role":
            if value.lower() in ROLES:
                said.add(BOILER)
        elif name not in CONTENT:
            for one in value.split():
                parts = set(_PARTS.split(_CAMEL.sub("-", one).lower()))
                if not HINTS & parts or MODIFIERS & parts:
                    continue
                if REMARKS & parts:
                    said.add(COMMENTS)
                elif one.lower() in LISTED or LISTED & parts - VAGUE - {"sidebar", "related"}:
                    said.add(BOILER)
                elif "related" in parts:
                    said.add(RELATED)
                else:
                    said.add(DOUBTFUL if HINTS & parts <= VAGUE else WRAPPER)
    return next((place for place in (COMMENTS, BOILER, RELATED, WRAPPER, DOUBTFUL) if place in said), None)


def _place(name: str, rest: str, outer: str | None) -> str | None:
    """What blocks inside an element are, given what they are around it."""
    hint = _hinted(name, rest)
    inside = outer in (TEXT, JUDGED)
    if COMMENTS in (outer, hint):
        return COMMENTS
    if name == "main" or re.search(r"""role\s*=\s*["']?main\b""", rest):
        return TEXT
    if BOILER in (outer, hint) or name in ASIDE or hint == RELATED and not inside:
        return BOILER
    if name == "article":
        return JUDGED if outer == JUDGED else TEXT
    if outer in (WRAPPER, FORM) or hint == WRAPPER:
        return WRAPPER if hint == WRAPPER or name in BOILERPLATE else outer
    if name in BOILERPLATE:
        # The header of an article holds its title.
        return TEXT if name == "header" and outer == TEXT else FORM if name == "form" else WRAPPER
    if hint in (DOUBTFUL, RELATED):
        return JUDGED if inside else DOUBTFUL
    return outer


def pieces(page: str) -> list[Piece]:
    """The blocks of a page in order."""
    found: list[Piece] = []
    stack: list[tuple[str, str | None, bool]] = [("", None, False)]  # element, place, silent
    held: list[str] = []
    linked = in_link = 0
    heading = False

    def end_block() -> None:
        nonlocal linked, heading
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            found.append(Piece(text, linked, stack[-1][1], heading))
        held.clear()
        linked, heading = 0, False

    def say(text: str) -> None:
        nonlocal linked
        if stack[-1][0] == "head" and text.strip():
            stack.pop()
        if not stack[-1][2]:
            held.append(text)
            if in_link:
                linked += len(text.strip())

    at = 0
    while tag := _TAG.search(page, at):
        say(page[at : tag.start()])
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            continue
        if not tag["close"] and stack[-1][0] == "head" and name not in IN_HEAD:
            # The end tag of a head may be left out.
            stack.pop()
        if name in BLOCKS or name in SILENT:
            end_block()
        if tag["close"]:
            if name == "a":
                in_link = max(0, in_link - 1)
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
            continue
        rest = tag["rest"]
        if name == "a":
            in_link += 1
        heading = heading or name in ("h1", "h2", "h3", "h4", "h5", "h6")
        if name in VOID or name in FOREIGN and rest.endswith("/>"):
            continue
        silent = stack[-1][2] or name in SILENT
        if name in RAW:
            close = re.compile(f"</{name}", re.I).search(page, at)
            at = close.start() if close else len(page)
        if name == "p" and stack[-1][0] == "p":
            stack.pop()
        if name == "li":
            # A list item ends the one before it in the same list.
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in ("ul", "ol", "menu"):
                    break
                if stack[depth][0] == "li":
                    del stack[depth:]
                    break
        if name in BLOCKS or name in SILENT:
            stack.append((name, _place(name, rest, stack[-1][1]), silent))
        elif "=" in rest and _hinted(name, rest):
            stack.append((name, _place(name, rest, stack[-1][1]), silent))
    say(page[at:])
    end_block()
    return found


def _without_whole_forms(blocks: list[Piece]) -> list[Piece]:
    """Blocks of forms that hold most of a page's text, as if there were no form."""
    inside = sum(len(b.text) for b in blocks if b.place == FORM)
    if 2 * inside <= sum(len(b.text) for b in blocks):
        return blocks
    return [replace(b, place=None) if b.place == FORM else b for b in blocks]


def first_pass(block: Piece) -> str | None:
    """A block's label by where it stands, its links, its length and its stop words."""
    if block.place in (TEXT, BOILER):
        return block.place
    if block.place in (COMMENTS, WRAPPER, FORM):
        return BOILER
    label = _by_its_words(block)
    return BOILER if block.place == DOUBTFUL and label != TEXT else label


def _by_its_words(block: Piece) -> str | None:
    words = _WORD.findall(block.text.lower())
    if block.linked > MOST_LINKS * len(block.text):
        return BOILER
    if len(block.text) < SHORT:
        return BOILER if "\N{COPYRIGHT SIGN}" in block.text else OPEN
    density = sum(w in _STOP for w in words) / max(1, len(words))
    if density >= MANY_STOP_WORDS or density >= FEW_STOP_WORDS and len(block.text) >= LONG:
        return TEXT
    return OPEN if density >= FEW_STOP_WORDS else BOILER


def second_pass(labels: list[str | None]) -> list[str]:
    """Undecided blocks take the label of the nearest decided neighbours; alone, they are text."""
    if not any(labels):
        return [TEXT] * len(labels)
    before: list[tuple[str, int]] = []
    last, at = BOILER, -1
    for i, label in enumerate(labels):
        last, at = (label, i) if label else (last, at)
        before.append((last, i - at if at >= 0 else len(labels) + 1))
    out: list[str] = [""] * len(labels)
    last, at = BOILER, -1
    for i in range(len(labels) - 1, -1, -1):
        last, at = (labels[i], i) if labels[i] else (last, at)
        ahead = at - i if at >= 0 else len(labels) + 1
        label, behind = before[i]
        same = label == last
        out[i] = labels[i] or (label if same or behind < ahead else last if ahead < behind else TEXT)
    return out


def main_text(page: str | None) -> str:
    blocks = _without_whole_forms(pieces(page or ""))
    labels = second_pass([first_pass(b) for b in blocks])
    return " ".join(b.text for b, label in zip(blocks, labels) if label == TEXT)


def extract(pages: DataFrame, most_rows: int = 256) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, most_rows):
                some = batch.slice(start, most_rows)
                texts = [main_text(page) for page in some.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("page_id"),
                        some.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array(np.array([len(t) for t in texts], np.int64)),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        read, f"page_id {kind}, url string, text string, n_chars long"
    )
