"""Titles and links from stored HTML.

Native column expressions, but for the hits of result pages: which element ends where is
told by a scan over the tags, one pass over each page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence
from html import unescape as unescaped
from html.entities import html5, name2codepoint

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Links that never lead to a company's own site, matched at the start of the link.
EXCLUDED_LINKS = [
    r"https:\/\/www\.linkedin\.com\/.+",
    r"https:\/\/vk\.com\/.+",
    r"https:\/\/www\.facebook\.com\/.+",
    r"https:\/\/twitter\.com\/.+",
    r"https:\/\/www\.instagram\.com\/.+",
    r"https:\/\/www\.youtube\.com\/.+",
    r"https:\/\/www\.pinterest\.com\/.+",
    r"https:\/\/www\.tumblr\.com\/.+",
    r"https:\/\/www\.wikipedia.org\/.+",
    r"https:\/\/www\.yelp\.com\/.+",
    r"https:\/\/www\.glassdoor\.com\/.+",
    r"https:\/\/www\.ok\.ru\/.+",
]
# Markup of one hit on a web-search result page.
HIT_CLASS, HIT_HEADING, HIT_DESCRIPTION_STYLE, HIT_DESCRIPTION = "g", "h3", "-webkit-line-clamp:2", "span"
# Fixed values of HTML: elements without an end, and elements whose content is not markup.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = ("script", "style")

_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")


def _code_point(c: Column) -> Column:
    """Character of a code point number, NULL where there is none."""
    valid = (c > 0) & (c < 0x110000) & ~c.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32"))


def _once(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` computed once, however often it is used: worth it for expressions over whole pages."""
    return F.transform(F.array(c), use)[0]


def unescape(c: Column) -> Column:
    """Resolve named, decimal and hexadecimal character references."""
    # A map held as text is one foldable literal instead of one expression per entity.
    table = F.str_to_map(
        F.lit(" ".join(f"{name}:{cp}" for name, cp in (name2codepoint | {"apos": 39}).items())), F.lit(" "), F.lit(":")
    )

    others = (f"{name[:-1]}\x02{text}" for name, text in html5.items() if name.endswith(";") and name[:-1] not in name2codepoint)
    rare = F.str_to_map(F.lit("\x01".join(others)), F.lit("\x01"), F.lit("\x02"))

    def resolve(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^(#[xX][0-9A-Fa-f]+|#[0-9]+|[A-Za-z][A-Za-z0-9]*);", 1)
        hexadecimal = F.conv(F.regexp_extract(name, "^#[xX](.+)$", 1), 16, 10).try_cast("bigint")
        decimal = F.regexp_extract(name, "^#([0-9]+)$", 1).try_cast("bigint")
        named = F.try_element_at(table, name).cast("bigint")
        # The long table is only looked at for names that are not among the usual ones.
        char = F.coalesce(_code_point(F.coalesce(decimal, hexadecimal, named)), F.try_element_at(rare, name))
        rest = F.substring(piece, F.length(name) + 2, F.lit(2**31 - 1))
        return F.when((name != "") & char.isNotNull(), F.concat(char, rest)).otherwise(F.concat(F.lit("&"), piece))

    def resolve_all(text: Column) -> Column:
        pieces = F.split(text, "&")
        tail = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), resolve)
        return F.when(text.contains("&"), F.concat(pieces[0], F.array_join(tail, ""))).otherwise(text)

    return _once(c, resolve_all)


def title(html: Column) -> Column:
    """Text of the first title element, empty when there is none."""
    return unescape(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def links(html: Column) -> Column:
    """Targets of all anchors in page order, in quotes or without."""
    bare = F.transform(
        F.regexp_extract_all(html, F.lit(_HREF), F.lit(1)),
        lambda v: F.when(v.rlike("^[\"']"), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v),
    )
    return F.transform(bare, unescape)


def hit_links(page: str) -> list[str]:
    """First link of every hit of a result page, in page order.

    A hit is a ``div`` of class ``g``. It counts if the link, a heading and a description
    stand inside it; the description is a ``span`` inside the first element of the
    description's style. An end tag closes the last open element of its name and all opened
    in it; one without such an element is passed over. Elements that never end reach to the
    end of the page. A hit inside another belongs to both.
    """
    hits: list[dict] = []
    stack: list[tuple[str, dict | None, list[dict]]] = []  # name, the hit it is, the hits whose description it is
    open_names: Counter[str] = Counter()
    inside: list[dict] = []  # open hits that still lack something
    at = 0
    while tag := _TAG.search(page, at):
        at = tag.end()
        if tag[2] is None:  # a comment
            continue
        name = tag[2].lower()
        if tag[1]:
            while open_names[name]:
                closed, hit, described = stack.pop()
                open_names[closed] -= 1
                if hit is not None:
                    hit["open"] = False
                for owner in described:
                    owner["box_open"] = False
                if closed == name:
                    break
            continue
        attributes = {k.lower(): unescaped(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(tag[3])} if name in ("a", "div") else {}
        inside = [hit for hit in inside if hit["open"] and not (hit["link"] and hit["heading"] and hit["text"])]
        described = []
        for hit in inside:
            if name == "a" and hit["link"] is None and "href" in attributes:
                hit["link"] = attributes["href"]
            elif name == HIT_HEADING:
                hit["heading"] = True
            elif name == HIT_DESCRIPTION and hit["box_open"]:
                hit["text"] = True
            elif name == "div" and not hit["box"] and attributes.get("style") == HIT_DESCRIPTION_STYLE:
                hit["box"] = hit["box_open"] = True
                described.append(hit)
        hit = None
        if name == "div" and HIT_CLASS in attributes.get("class", "").split():
            hit = {"open": True, "link": None, "heading": False, "box": False, "box_open": False, "text": False}
            hits.append(hit)
            inside.append(hit)
        if name in RAW:
            end = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
        if name not in VOID:
            stack.append((name, hit, described))
            open_names[name] += 1
    return [hit["link"] for hit in hits if hit["link"] is not None and hit["heading"] and hit["text"]]


@F.pandas_udf(ArrayType(StringType()))
def _hit_links(pages: pd.Series) -> pd.Series:
    return pages.map(lambda page: [] if page is None else hit_links(page))


def result_links(html: Column) -> Column:
    """Links of the hits of a result page; pages without a heading are not sent to the scan."""
    return _hit_links(F.when(html.rlike(rf"(?i)<{HIT_HEADING}[\s/>]"), html))


def is_excluded(link: Column, patterns: Sequence[str] = EXCLUDED_LINKS) -> Column:
    """True when any pattern matches at the start of the link."""
    if not patterns:
        return F.lit(False)
    return link.rlike("^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")")
