"""Reading the article fields out of one HTML page.

This is the per-row helper behind ``operators.articles.extract_articles``. It walks the
page once as a stream of events and builds no tree: each element of interest remembers
where in the list of text pieces it began and ended.
"""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from dataclasses import dataclass
from html.parser import HTMLParser

from tallyloom.functions.dates import ISO_DATE

# Where each kind of site keeps title and body, as (tag, class) in order
# of preference, and the texts that stand for a missing part.
LAYOUTS = {
    "yourstory": ((("h1", "article-title"), ("h1", None)),
                  (("div", "article-content"), ("article", None))),
    "finshots": ((("h1", "post-title"), ("h1", None)),
                 (("div", "post-content"), ("article", None))),
}
GENERIC_LAYOUT = ((("h1", None),), (("article", None), ("main", None)))
DATE_META = "article:published_time"
NO_TITLE = "No title found"
NO_CONTENT = "No content found"

# Elements without content, and elements whose content is not text.
VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
NOT_TEXT = frozenset(("script", "style", "template"))


@dataclass
class Span:
    """An element's attributes and its range in the list of text pieces."""

    attributes: dict[str, str]
    start: int
    end: int | None = None


class FirstMatches(HTMLParser):
    """Finds the first element for every wanted (tag, class).

    An end tag closes the innermost open element of that name and all within it; one
    that closes nothing is ignored. Elements left open run to the end of the page.
    """

    def __init__(self, wanted):
        super().__init__(convert_charrefs=True)
        self.wanted = set(wanted)
        self.found: dict[tuple, Span] = {}
        self.pieces: list[str] = []
        self.open_elements: list[tuple[str, list[Span]]] = []
        self.open_names: Counter[str] = Counter()
        self.silent = 0

    def handle_starttag(self, tag, attrs):
        attributes = {name: value or "" for name, value in attrs}
        classes = attributes.get("class", "").split()
        names = [(tag, None), *((tag, name) for name in classes)]
        if tag == "meta":
            names.append((tag, attributes.get("property")))
        spans = []
        for name in names:
            if name in self.wanted and name not in self.found:
                self.found[name] = Span(attributes, len(self.pieces))
                spans.append(self.found[name])
        if tag in VOID:
            for span in spans:
                span.end = span.start
            return
        self.open_elements.append((tag, spans))
        self.open_names[tag] += 1
        self.silent += tag in NOT_TEXT

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.open_names[tag]:
            return
        name = None
        while name != tag:
            name, spans = self.open_elements.pop()
            self.open_names[name] -= 1
            self.silent -= name in NOT_TEXT
            for span in spans:
                span.end = len(self.pieces)

    def handle_data(self, data):
        if not self.silent:
            self.pieces.append(data)

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self.handle_data(data[len("CDATA["):])

    def text(self, span: Span) -> str:
        return "".join(self.pieces[span.start:span.end])


def first_of(parser: FirstMatches, names) -> Span | None:
    return next((parser.found[name] for name in names if name in parser.found), None)


def iso_or(text: str, fallback: str) -> str:
    """The date in ISO form, or the fallback for anything that is not an ISO date."""
    spelled = text.replace("Z", "+00:00")
    if not re.match(ISO_DATE, spelled, re.ASCII):
        return fallback
    try:
        return dt.datetime.fromisoformat(spelled).isoformat()
    except ValueError:
        return fallback


def parse_article(html: str, source: str | None, ingested_at: str) -> dict[str, str]:
    """Title, text and publish date of a page. ``found`` counts title and text only."""
    titles, bodies = LAYOUTS.get((source or "").lower(), GENERIC_LAYOUT)
    dates = (("time", None), ("meta", DATE_META))
    parser = FirstMatches((*titles, *bodies, *dates))
    parser.feed(html)
    parser.close()
    title, body, date = (first_of(parser, names) for names in (titles, bodies, dates))
    published = ingested_at
    if date is not None:
        stated = (date.attributes.get("datetime") or date.attributes.get("content")
                  or parser.text(date))
        published = iso_or(stated, ingested_at)
    return {
        "title": NO_TITLE if title is None else parser.text(title).strip(),
        "text": NO_CONTENT if body is None else parser.text(body).strip(),
        "published": published,
        "found": (title is not None) + (body is not None),
    }
