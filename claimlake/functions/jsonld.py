"""JSON-LD of a page: its nodes in document order, and the fields that articles and reviews carry."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.functions import html

_NUMBER = re.compile(r"\d+(?:[.,]\d+)?")
_BODY = "article p::text, .article-body p::text, .content-text p::text, [itemprop='articleBody'] p::text"


def text_of(value: Any) -> str | None:  # noqa: ANN401
    """Any scalar as squeezed text; blank is None."""
    return None if value is None else " ".join(str(value).split()) or None


def first_of(*values: Any) -> str | None:  # noqa: ANN401
    """The first text that isn't blank; lists are searched in order."""
    for value in values:
        for v in value if isinstance(value, (list, tuple)) else (value,):
            if found := text_of(v):
                return found
    return None


def as_list(value: Any) -> list:  # noqa: ANN401
    return [] if value is None else value if isinstance(value, list) else [value]


def unique(values: list[Any]) -> list[str]:
    """Squeezed texts without blanks and repeats; case counts."""
    return list(dict.fromkeys(t for v in values if (t := text_of(v))))


def names(value: Any) -> list[str]:  # noqa: ANN401
    """The names of objects, or the texts themselves."""
    return unique([first_of(v.get("name"), v.get("headline")) if isinstance(v, dict) else v for v in as_list(value)])


def keywords(value: Any) -> list[str]:  # noqa: ANN401
    return unique([k for v in as_list(value) if v is not None for k in str(v).split(",")])


def flatten(payload: Any) -> list[dict]:  # noqa: ANN401
    """All objects of a document: lists are opened, an object with a graph gives only the graph's members."""
    if isinstance(payload, list):
        return [node for p in payload for node in flatten(p)]
    if not isinstance(payload, dict):
        return []
    return flatten(payload["@graph"]) if isinstance(payload.get("@graph"), list) else [payload]


def nodes(page: html.Node) -> list[dict]:
    """The page's JSON-LD objects in document order; blank and broken scripts are passed over."""
    found: list[dict] = []
    for raw in html.select(page, "script[type='application/ld+json']::text"):
        try:
            found += flatten(json.loads(raw))
        except json.JSONDecodeError:
            continue
    return found


def pick(found: list[dict], *types: str) -> dict:
    """The first object of the first type that has one; without any the first object, or an empty one."""
    for kind in types:
        for node in found:
            if kind in as_list(node.get("@type")):
                return node
    return found[0] if found else {}


def verdict_and_rating(review: dict) -> tuple[str | None, str | None]:
    """The review's verdict in words, and its numbers; a verdict that is only a number is none."""
    rating = review.get("reviewRating")
    if not isinstance(rating, dict):
        return None, None
    words = [t for k in ("alternateName", "name") if (t := text_of(rating.get(k))) and not _NUMBER.fullmatch(t)]
    return (words[0] if words else None), first_of(*(rating.get(k) for k in ("ratingValue", "bestRating", "worstRating")))


def author(page: html.Node, *items: dict) -> str | None:
    one = lambda v: first_of(v.get("name"), v.get("alternateName")) if isinstance(v, dict) else None if isinstance(v, list) else text_of(v)
    for item in items:
        if found := ", ".join(n for v in as_list(item.get("author")) if (n := one(v))):
            return found
    return html.first(page, "meta[name='author']::attr(content)", "meta[property='article:author']::attr(content)")


def body(page: html.Node, *items: dict) -> str | None:
    if found := first_of(*(i.get("articleBody") for i in items)):
        return found
    return " ".join(t for p in html.select(page, _BODY) if (t := text_of(p))) or None


def taxonomy(*items: dict) -> dict[str, list[str]]:
    return {
        "topics": unique([n for i in items for k in ("articleSection", "about") for n in names(i.get(k))]),
        "tags": unique([k for i in items for k in keywords(i.get("keywords"))]),
        "entities": unique([n for i in items for n in names(i.get("mentions"))]),
    }


def source_type(*items: dict) -> str | None:
    return next((t for i in items if (t := text_of(",".join(map(str, as_list(i.get("@type"))))))), None)


def language(page: html.Node, *items: dict) -> str | None:
    return first_of(*(i.get("inLanguage") for i in items)) or html.first(page, "html::attr(lang)")


def canonical_address(page: html.Node, url: str, *items: dict) -> str:
    """The address the page gives as its own, absolute; not yet in canonical form."""
    found = None
    for item in items:
        main = item.get("mainEntityOfPage")
        found = first_of(item.get("url"), *((main.get("@id"), main.get("url")) if isinstance(main, dict) else (main,)))
        if found:
            break
    found = found or html.first(page, "link[rel='canonical']::attr(href)", "meta[property='og:url']::attr(content)")
    return urljoin(url, found) if found else url


@F.udtf(returnType=T.StructType().add("pos", "integer").add("type", "string").add("node", "string"))
class JsonLdNodes:
    """``SELECT * FROM jsonld_nodes(html)``: one row per JSON-LD object of a page."""

    def eval(self, markup: str):  # noqa: ANN201, D102
        for i, node in enumerate(nodes(html.parse(markup))):
            yield i, ",".join(map(str, as_list(node.get("@type")))), json.dumps(node, ensure_ascii=False)


@F.pandas_udf(T.ArrayType(T.StringType()))
def jsonld_nodes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The same as an array of JSON texts, for use on a column."""
    for pages in batches:
        yield pd.Series([[json.dumps(n, ensure_ascii=False) for n in nodes(html.parse(p))] for p in pages])
