"""From fetched pages to records: one table of rules says, per agency, where each field comes from.

``responses`` has ``url, status, headers, body, meta, spider`` (``meta`` and
``headers`` may be absent).  A page is parsed once; the rules are evaluated on it.
A rule is a source: ``C.x`` and ``A.x`` are fields of the claim review and of the
article object, ``css:`` a selector, a bare name a field computed before it.
"""

from __future__ import annotations

import codecs
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.functions import html
from claimlake.functions import jsonld as j
from claimlake.functions.labels import VERDICT_PATTERNS
from claimlake.functions.urls import canonical
from claimlake.operators.timestamps import MONTHS

# Markers of a page that blocks robots, and where they are looked for.
BLOCK_MARKERS = ("just a moment", "attention required", "cf-browser-verification", "/cdn-cgi/challenge-platform")
BLOCK_BYTES = 32_768
BLOCK_STATUSES = (401, 403, 429, 503)

_OG, _H1, _T = "css:meta[property='og:title']::attr(content)", "css:h1::text", "css:title::text"
_PUB, _TIME = "css:meta[property='article:published_time']::attr(content)", "css:time::attr(datetime)"
_DESC, _OGD = "css:meta[name='description']::attr(content)", "css:meta[property='og:description']::attr(content)"
_ITEMDATE = "css:meta[itemprop='datePublished']::attr(content)"
_KEYS, _NEWSKEYS = "meta[name='keywords']::attr(content)", "meta[name='news_keywords']::attr(content)"
_SECTION = "meta[property='article:section']::attr(content)"


@dataclass(frozen=True)
class Rules:
    """Where one agency's fields come from.  Defaults are what most agencies share."""

    agency_name: str
    types: tuple[str, ...] = ("NewsArticle", "Article", "WebPage")
    review: bool = True
    title: tuple[str, ...] = ("A.headline", "A.name", _OG, _H1, _T)
    published: tuple[str, ...] = ("C.datePublished", "A.datePublished", "A.dateModified")
    summary: tuple[str, ...] = ("C.reviewBody", "A.description", _DESC, _OGD)
    claim: tuple[str, ...] = ("C.claimReviewed", "title", "summary")
    #: ``inferred`` reads the verdict from these texts; ``stated`` is the review's own.
    verdict: tuple[str, ...] = ("inferred", "stated")
    infer_from: tuple[str, ...] = ("stated", "title", "summary")
    #: Order of review and article for author, body, language and taxonomy; and for the kind of source.
    order: str = "CA"
    kind_order: str = ""
    country: str | None = "BR"
    meta_keywords: tuple[str, ...] = ()
    topics_css: tuple[str, ...] = ()
    tags_css: tuple[str, ...] = ()
    drop_topics: tuple[str, ...] = ()
    blocked: tuple[int, ...] = ()
    agency_id: str | None = None
    special: tuple[str, ...] = field(default=())


# The precedence table.
RULES: dict[str, Rules] = {
    "afp_checamos": Rules("AFP Checamos", published=("C.datePublished", "A.datePublished", "A.dateModified", _PUB, _TIME), summary=("A.description", "C.reviewBody", _DESC, _OGD), meta_keywords=(_KEYS,)),
    "agencia_lupa": Rules(
        "Agencia Lupa", title=("C.headline", "A.headline", "C.name", "A.name", _H1, _OG, _T), published=("C.datePublished", "A.datePublished", "A.dateModified", _PUB, _TIME),
        summary=("C.reviewBody", "A.description", "A.alternateName", "A.abstract", _DESC, _OGD), claim=("C.claimReviewed", "A.claimReviewed", "title", "summary"),
        verdict=("stated", "inferred"), infer_from=("title", "summary"), meta_keywords=(_KEYS,),
    ),
    "aos_fatos": Rules("Aos Fatos", types=("NewsArticle", "Article", "Review"), claim=("C.claimReviewed", "title"), order="AC", kind_order="CA", meta_keywords=(_KEYS,)),
    "boatos_org": Rules("Boatos.org", review=False, published=("A.datePublished", _PUB, "A.dateModified"), summary=("A.description", _DESC, _OGD), claim=("title_without_tag",), verdict=("inferred",), infer_from=("title", "summary"), order="A"),
    "e_farsas": Rules(
        "E-farsas", types=("ClaimReview", "NewsArticle", "Article", "WebPage"), review=False, published=("A.datePublished", _PUB, "A.dateModified"), summary=("A.description", _DESC, _OGD),
        claim=("title",), verdict=("inferred",), infer_from=("topics", "tags", "title", "summary"), order="A", drop_topics=("Falso", "Verdadeiro", "Impreciso", "Errado", "Verdade, mas"),
    ),
    "estadao_verifica": Rules(
        "Estadao Verifica", types=("NewsArticle", "Report", "Article", "WebPage"), title=("C.headline", "A.headline", "C.name", "A.name", _OG, _T),
        published=("C.datePublished", "A.datePublished", "A.dateModified", "A.dateCreated", _PUB), claim=("C.claimReviewed", "summary"), verdict=("stated", "inferred"), infer_from=("title", "summary"), meta_keywords=(_KEYS,),
    ),
    "g1_fato_ou_fake": Rules(
        "G1 Fato ou Fake", review=False, title=("A.headline", "A.name", "css:h1.content-head__title::text", _OG, _T), published=("A.datePublished", _ITEMDATE, "css:time[itemprop='datePublished']::attr(datetime)", _PUB, "A.dateModified"),
        summary=("A.description", "css:h2.content-head__subtitle::text", "css:meta[itemprop='alternateName']::attr(content)", _DESC, _OGD), claim=("title_without_mark",), verdict=("marked",), order="A",
        special=("section_if_no_topics", "keywords_if_no_tags", "itemtype"),
    ),
    "observador": Rules("Observador", published=("C.datePublished", "A.datePublished", "A.dateModified", _TIME), summary=("A.description", "C.reviewBody", _DESC, _OGD), country="PT", blocked=(403, 429, 503)),
    "poligrafo": Rules(
        "Poligrafo", types=(), review=False, title=(_OG, _H1, _T), published=("portuguese:.custom-post-date-time::text",), summary=("css:.post-excerpt::text", _DESC, _OGD), claim=("title",),
        verdict=("css:#footer-result .fact-check-result span::text",), order="", country="PT", topics_css=(".custom-post-categories::text",), special=("fact_check",),
    ),
    "projeto_comprova": Rules("Projeto Comprova", summary=("C.reviewBody", "stated_text", "A.description", _DESC, _OGD), verdict=("inferred", "stated_label"), infer_from=("stated_label", "title", "summary"), order="AC", kind_order="CA", meta_keywords=(_KEYS,)),
    "publico": Rules(
        "Publico", review=False, published=("A.datePublished", "A.dateCreated", "A.dateModified", _PUB), summary=("A.description", _DESC, _OGD), claim=("title_without_verdict",), verdict=("inferred",),
        infer_from=("title", "keywords"), order="A", country="PT", meta_keywords=(_KEYS, _NEWSKEYS), special=("series",),
    ),
    "reuters_fact_check": Rules(
        "Reuters Fact Check", published=("C.datePublished", "A.datePublished", "A.dateModified", _PUB, _TIME), summary=("A.description", "C.reviewBody", _DESC, _OGD), country=None, meta_keywords=(_KEYS,), blocked=(401, 403), agency_id="reuters",
    ),
    "uol_confere": Rules(
        "UOL Confere", title=("A.headline", "A.name", "C.headline", "C.name", _OG, _T), published=("C.datePublished", "A.datePublished", "A.dateModified", _PUB, _ITEMDATE),
        summary=("C.reviewBody", "css:h2.content-head__subtitle::text", "css:.content-head__subtitle::text", "css:[data-testid='article-subtitle']::text", "A.description", _DESC, _OGD), claim=("C.claimReviewed", "title"),
        verdict=("stated", "inferred"), infer_from=("title", "summary"), topics_css=(_SECTION, ".article-topics a::text", "[data-testid='article-breadcrumb'] a::text"),
        tags_css=(".article-tags a::text", "[data-testid='article-tags'] a::text"), meta_keywords=(_KEYS, _NEWSKEYS), special=("generic_summary",),
    ),
}

# A portal's boiler-plate summary, and the series that one agency's fact checks belong to.
GENERIC_SUMMARY = "Veja as principais notícias e manchetes do dia no Brasil e no Mundo."
SERIES = "prova dos factos"

_MARK = re.compile(r"(?i)#?(FAKE|FATO|VERDADE)\b")
_LONG_DATE = re.compile(r"(?i)(\d{1,2}) de (\w+) de (\d{4})(?: [àa]s? (\d{1,2}:\d{2}))?")
_MONTHS = {w: f"{n:02d}" for n, words in MONTHS.items() for w in (words.split()[0], "marco" if n == 3 else words.split()[0])}
_VERDICTS = tuple((re.compile(rx), v) for rx, v in VERDICT_PATTERNS)


def infer(values: list) -> str | None:
    """The verdict that the first value with any names."""
    for value in values:
        low = (j.text_of(value) or "").lower()
        for rx, verdict in _VERDICTS:
            if low and rx.search(low):
                return verdict
    return None


def long_date(text: str | None) -> str | None:
    """A Portuguese long date as ISO 8601; other text as it is."""
    text = j.text_of(text)
    m = _LONG_DATE.match(text or "")
    month = _MONTHS.get(m.group(2).lower()) if m else None
    return f"{m.group(3)}-{month}-{int(m.group(1)):02d}T{m.group(4) or '00:00'}:00" if m and month else text


def _plain(text: str) -> str:
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()


def is_blocked(status: int, body: str | None, statuses: tuple[int, ...] = BLOCK_STATUSES) -> bool:
    head = (body or "")[:BLOCK_BYTES].lower()
    return status in statuses or any(m in head for m in BLOCK_MARKERS)


def looks_blocked(status: Column, body: Column, statuses: tuple[int, ...] = BLOCK_STATUSES) -> Column:
    """The same inside Spark: whether a response is a robot check instead of a page."""
    head = F.lower(F.substring(F.coalesce(body, F.lit("")), 1, BLOCK_BYTES))
    marked = F.lit(False)
    for m in BLOCK_MARKERS:
        marked = marked | F.contains(head, F.lit(m))
    return F.coalesce(status.isin(*statuses), F.lit(False)) | marked


def looks_like_html(body: Column, content_type: Column) -> Column:
    start = F.lower(F.ltrim(F.coalesce(body, F.lit(""))))
    return F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("html")) | start.rlike(r"^\s*<(!doctype html|html|head|body)")


def extract(spider: str, url: str, status: int, markup: str | None) -> dict:
    """One page as a record of strings and lists, with ``errors``; an unknown spider goes by the defaults."""
    rules = RULES.get(spider) or Rules(spider.replace("_", " ").title())
    record: dict = {"spider": spider, "agency_id": rules.agency_id or spider, "agency_name": rules.agency_name, "country": rules.country}
    if rules.blocked and is_blocked(status, markup, rules.blocked):
        return record | {"errors": ["blocked"]}
    if "series" in rules.special and "/newsletter/" in url:
        return record | {"errors": ["newsletter"]}
    page = html.parse(markup)
    if "series" in rules.special and SERIES not in (next((k for s in (_KEYS, _NEWSKEYS) if (k := html.first(page, s))), "") or "").lower():
        return record | {"errors": ["other_series"]}
    found = j.nodes(page)
    objects = {"C": j.pick(found, "ClaimReview") if rules.review else {}, "A": j.pick(found, *rules.types) if rules.types else {}}
    in_order = [objects[k] for k in rules.order]
    known: dict = {}

    def value(source: str):  # noqa: ANN202
        kind, _, rest = source.partition(":")
        if kind == "css":
            return html.first(page, rest)
        if kind == "portuguese":
            return long_date(html.first(page, rest))
        if source[1:2] == "." and source[0] in objects:
            return objects[source[0]].get(source[2:])
        return known.get(source)

    get = lambda sources: j.first_of(*map(value, sources))
    stated, rating = j.verdict_and_rating(objects["C"])
    parts = (stated or "").split(":", 1)
    known |= {"stated": stated, "stated_label": j.text_of(parts[0]) if len(parts) == 2 else stated, "stated_text": j.text_of(parts[1]) if len(parts) == 2 else None}
    known["title"] = title = get(rules.title)
    known["summary"] = summary = get(rules.summary)
    if summary and "generic_summary" in rules.special and _plain(summary).startswith(_plain(GENERIC_SUMMARY)):
        known["summary"] = summary = None

    lists = j.taxonomy(*in_order)
    meta = [k for s in rules.meta_keywords for k in j.keywords((html.select(page, s) or [None])[0])]
    lists["tags"] = j.unique(lists["tags"] + [t for s in rules.tags_css for t in html.select(page, s)] + meta)
    lists["topics"] = [t for t in j.unique(lists["topics"] + [t for s in rules.topics_css for t in html.select(page, s)]) if t not in rules.drop_topics]
    if "section_if_no_topics" in rules.special and not lists["topics"]:
        lists["topics"] = j.unique(html.select(page, _SECTION))
    if "keywords_if_no_tags" in rules.special and not lists["tags"]:
        lists["tags"] = j.keywords((html.select(page, _KEYS) or [None])[0])
    known |= {"topics": j.taxonomy(*in_order)["topics"], "tags": lists["tags"], "keywords": meta}

    marks = [m.group(1).upper() for t in [title, *html.select(page, "strong::text"), *html.select(page, _OG[4:])] if (m := _MARK.search(t or ""))]
    known["marked"] = marks[0] if marks else None
    texts = [t for s in rules.infer_from for t in j.as_list(known.get(s))]
    known["inferred"] = infer(texts)
    verdict = get(rules.verdict)
    if title:
        known["title_without_tag"] = re.sub(r"(?i)\s+#boato\b", "", title).strip()
        known["title_without_verdict"] = re.sub(r"(?i)\s+(Verdadeiro|Falso|Errado|Impreciso|Verdade,?\s*mas)$", "", title)
        mark = re.escape(known["marked"]) if known["marked"] else None
        known["title_without_mark"] = j.text_of(re.sub(rf"(?i)^\s*[EÉ]\s+#?{mark}\b\s*(?:que\b)?\s*[:\-–—]?\s*", "", title)) if mark else title
    else:
        known["title_without_tag"] = summary
    kind = j.source_type(*(objects[k] for k in rules.kind_order or rules.order))
    if "itemtype" in rules.special and not kind:
        kind = j.text_of((html.select(page, "main[itemtype]::attr(itemtype)") or [""])[0].rsplit("/", 1)[-1])
    if "fact_check" in rules.special:
        kind = "fact_check"
    published, address = get(rules.published), canonical(j.canonical_address(page, url, *in_order))
    record |= {
        "source_url": url, "canonical_url": address, "title": title, "published_at": published, "claim": get(rules.claim), "summary": summary, "verdict": verdict,
        "rating": rating or verdict, "author": j.author(page, *in_order), "body": j.body(page, *in_order), "language": j.language(page, *in_order), "source_type": kind, **lists,
    }
    own = canonical(title) if title and re.match(r"(?i)https?://[^/?#]", title) else None
    reasons = {
        "missing_title": not title,
        "title_matches_url": own is not None and own in {canonical(url), address},
        "missing_published_at": not published,
        "placeholder_published_at": published in ("-", "–", "—"),
    }
    return record | {"errors": [code for code, bad in reasons.items() if bad]}


_TEXTS = ("spider", "agency_id", "agency_name", "source_url", "canonical_url", "title", "published_at", "claim", "summary", "verdict", "rating", "author", "body", "language", "country", "source_type")
_RECORD = T.StructType([T.StructField(f, T.StringType()) for f in _TEXTS] + [T.StructField(f, T.ArrayType(T.StringType())) for f in ("topics", "tags", "entities", "errors")])


def extract_articles(responses: DataFrame, collected_at: Column | None = None) -> DataFrame:
    """``responses`` with the record's fields; ``errors`` says why a page gives no article.

    Null bodies give ``missing_title``.  A page is parsed where it is read; nothing is shuffled.
    """

    @F.pandas_udf(_RECORD)
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for spiders, urls_, statuses, bodies in batches:
            rows = [extract(s or "unknown", u or "", int(n) if n == n and n is not None else 0, b) for s, u, n, b in zip(spiders, urls_, statuses, bodies, strict=True)]
            yield pd.DataFrame([{f: r.get(f, [] if f in ("topics", "tags", "entities", "errors") else None) for f in _RECORD.fieldNames()} for r in rows], columns=_RECORD.fieldNames())

    made = responses.select("url", "status", run("spider", "url", F.col("status").cast("int"), "body").alias("r")).select("url", "status", "r.*")
    return made.withColumn("collected_at", collected_at if collected_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))


@F.pandas_udf(T.StringType())
def _decoded(bodies: pd.Series, charsets: pd.Series) -> pd.Series:
    """Bytes by their charset; null where there are none."""
    out = []
    for body, charset in zip(bodies, charsets, strict=True):
        try:
            codecs.lookup(charset or "utf-8")
        except LookupError:
            charset = None
        out.append(None if body is None else bytes(body).decode(charset or "utf-8", "replace"))
    return pd.Series(out, dtype=object)


def normalised_responses(responses: DataFrame) -> DataFrame:
    """Fetched bytes as text: UTF-8 for HTML, else the charset of the header; ``needs_refetch`` where a robot check came back.

    HTML is told by its content type or by how it begins, and its content type says
    UTF-8 afterwards.  Headers that speak of the bytes as sent are dropped.  Bytes
    that a charset doesn't have come out as U+FFFD, an unknown charset counts as UTF-8.
    """
    kind = F.lower(F.coalesce(F.try_element_at("headers", F.lit("Content-Type")), F.try_element_at("headers", F.lit("content-type")), F.lit("")))
    # Headers that describe the bytes as sent, not as kept; what HTML begins with.
    gone = ("content-encoding", "transfer-encoding", "content-length", "content-md5")
    begins = "<!doctype html", "<html", "<head", "<body"
    start = F.lower(F.ltrim(F.regexp_replace(F.decode(F.substring("body", 1, 1024), "ISO-8859-1"), r"^\s+", "")))
    html = F.coalesce(F.contains(kind, F.lit("html")), F.lit(False))
    for b in begins:
        html = html | F.coalesce(F.startswith(start, F.lit(b)), F.lit(False))
    kept = F.map_filter("headers", lambda k, _: ~F.lower(k).isin(*gone))
    other = F.map_filter(kept, lambda k, _: F.lower(k) != "content-type")
    headers = F.when(html, F.map_concat(other, F.create_map(F.lit("Content-Type"), F.lit("text/html; charset=utf-8")))).otherwise(kept)
    charset = F.when(html, "utf-8").otherwise(F.nullif(F.trim(F.regexp_extract(kind, r"charset=([^;]+)", 1)), F.lit("")))
    # UTF-8 is read inside Spark; only other charsets, and bytes that aren't UTF-8, go to Python.
    plain = F.when(F.coalesce(charset, F.lit("utf-8")).isin("utf-8", "utf8"), F.try_validate_utf8(F.col("body").cast("string")))
    text = F.coalesce(plain, _decoded(F.when(plain.isNull(), F.col("body")), charset))
    return responses.withColumns({"body": text, "headers": headers}).withColumn("needs_refetch", looks_blocked(F.col("status"), F.col("body")))

