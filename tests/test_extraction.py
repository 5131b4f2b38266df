import json

import pytest

from claimlake.functions import html, jsonld
from claimlake.operators import discovery as d
from claimlake.operators import extraction as x


def page(*nodes, head="", body="", lang="pt-BR"):
    scripts = "".join(f'<script type="application/ld+json">{n if isinstance(n, str) else json.dumps(n)}</script>' for n in nodes)
    return f'<html lang="{lang}"><head>{head}{scripts}</head><body>{body}</body></html>'


ARTICLE = {
    "@type": "NewsArticle", "headline": "Manchete", "datePublished": "2026-03-01", "description": "Descrição", "url": "https://e.com/a?utm_x=1", "author": [{"name": "Ana"}, {"name": "Rui"}],
    "keywords": "a, b", "articleSection": ["S"], "mentions": [{"name": "M"}], "inLanguage": "pt",
}
REVIEW = {"@type": ["Review", "ClaimReview"], "claimReviewed": "Alegação", "reviewBody": "Corpo", "reviewRating": {"alternateName": "Falso", "ratingValue": 1}}


@pytest.mark.parametrize("spider", sorted(x.RULES))
def test_every_agency_reads_a_full_page(spider):
    head = "<meta name='keywords' content='k1,k2, prova dos factos'><meta property='og:title' content='Título OG'><meta name='description' content='Meta'>"
    body = "<div class='custom-post-date-time'>4 de março de 2026</div><div id='footer-result'><p class='fact-check-result'><span>Falso</span></p></div>"
    rules = x.RULES[spider]
    got = x.extract(spider, "https://e.com/p", 200, page(*((ARTICLE, REVIEW) if rules.review else (ARTICLE,)), head=head, body=body))
    assert got["errors"] == [] and got["agency_id"] == ("reuters" if spider == "reuters_fact_check" else spider) and got["country"] == rules.country
    assert got["title"] == ("Título OG" if spider == "poligrafo" else "Manchete")
    assert got["published_at"] == ("2026-03-04T00:00:00" if spider == "poligrafo" else "2026-03-01")
    if rules.review:
        assert (got["claim"], got["verdict"], got["rating"]) == ("Alegação", "Falso", "1")
    if rules.order:
        assert got["author"] == "Ana, Rui" and got["language"] == "pt" and got["entities"] == ["M"] and got["canonical_url"] == "https://e.com/a"


def test_agency_peculiarities():
    boatos = x.extract("boatos_org", "u", 200, page({"@type": "Article", "headline": "Vacina mata #boato", "datePublished": "d"}))
    assert (boatos["claim"], boatos["verdict"], boatos["rating"]) == ("Vacina mata", "Falso", "Falso")
    farsas = x.extract("e_farsas", "u", 200, page({"@type": "Article", "headline": "T", "datePublished": "d", "articleSection": ["Falso", "Saúde"]}))
    assert farsas["topics"] == ["Saúde"] and farsas["verdict"] == "Falso"
    g1 = x.extract("g1_fato_ou_fake", "u", 200, page(head="<meta property='article:section' content='G1'>", body="<main itemtype='http://schema.org/NewsArticle'><h1 class='content-head__title'>É #FAKE que a lua caiu</h1><time itemprop='datePublished' datetime='2025'></time></main>"))
    assert (g1["verdict"], g1["claim"], g1["topics"], g1["source_type"], g1["published_at"]) == ("FAKE", "a lua caiu", ["G1"], "NewsArticle", "2025")
    comprova = x.extract("projeto_comprova", "u", 200, page(ARTICLE, {"@type": "ClaimReview", "reviewRating": {"name": "Enganoso: porque sim"}}))
    assert comprova["verdict"] == "Enganoso" and comprova["summary"] == "porque sim"
    uol = x.extract("uol_confere", "u", 200, page({"@type": "Article", "headline": "T", "datePublished": "d", "description": x.GENERIC_SUMMARY + " Mais"}))
    assert uol["summary"] is None
    lupa = x.extract("agencia_lupa", "https://e.com/p", 200, page(ARTICLE))
    assert lupa["verdict"] is None and lupa["rating"] is None
    publico = x.extract("publico", "https://e.com/p", 200, page(ARTICLE, head="<meta name='keywords' content='outra'>"))
    assert publico["errors"] == ["other_series"] and x.extract("publico", "https://e.com/newsletter/x", 200, "")["errors"] == ["newsletter"]
    assert x.extract("reuters_fact_check", "u", 401, "")["errors"] == ["blocked"]


def test_rejections_and_broken_pages():
    assert x.extract("aos_fatos", "https://e.com/p", 200, None)["errors"] == ["missing_title", "missing_published_at"]
    own = page({"@type": "Article", "headline": "https://e.com/p?utm_source=1", "datePublished": "–"})
    assert x.extract("aos_fatos", "https://e.com/p", 200, own)["errors"] == ["title_matches_url", "placeholder_published_at"]
    assert x.extract("aos_fatos", "u", 200, page("{broken", "", ARTICLE))["title"] == "Manchete"
    assert x.extract("new_agency", "u", 200, page(ARTICLE))["agency_name"] == "New Agency"


def test_jsonld():
    tree = html.parse(page([{"@type": "A"}, {"@graph": [{"@type": "B"}, 3]}], {"@type": "C"}))
    found = jsonld.nodes(tree)
    assert [n["@type"] for n in found] == ["A", "B", "C"]
    assert jsonld.pick(found, "Z", "C")["@type"] == "C" and jsonld.pick(found, "Z")["@type"] == "A" and jsonld.pick([], "Z") == {}
    assert jsonld.verdict_and_rating({"reviewRating": {"alternateName": "4,5", "bestRating": 4}}) == (None, "4")
    assert jsonld.verdict_and_rating({"reviewRating": "x"}) == (None, None)
    assert jsonld.canonical_address(html.parse("<link rel='canonical' href='/b'>"), "https://e.com/a") == "https://e.com/b"
    assert jsonld.body(html.parse("<article><p>a<b>x</b> c<p>d</article>")) == "a c d"


def test_selectors():
    tree = html.parse("<div id=m class='a b'><a href='/x?page=2'>1</a><span><a rel=next>2</a></span></div><p>t<br>u")
    assert html.select(tree, "#m > a::text") == ["1"] and html.select(tree, "div.a.b a::text, p::text") == ["1", "2", "t", "u"]
    assert html.select(tree, "a[href*='page=']::attr(href)") == ["/x?page=2"] and html.first(tree, "h1::text", "a[rel='next']::text") == "2" and html.first(tree, "h9::text") is None


def test_blocked(spark):
    df = spark.createDataFrame([(200, "<title>Just a moment</title>"), (403, ""), (200, "x" * 40000 + "just a moment"), (None, None)], "status int, body string")
    assert [r[0] for r in df.select(x.looks_blocked(df["status"], df["body"])).collect()] == [True, True, False, False]
    assert [r[0] for r in df.select(x.looks_like_html(df["body"], df["body"])).collect()] == [False, False, False, False]


def test_extract_in_spark(spark):
    df = spark.createDataFrame([("aos_fatos", "https://e.com/p", 200, page(ARTICLE, REVIEW)), ("x", None, None, None)], "spider string, url string, status int, body string")
    got = x.extract_articles(df).collect()
    assert got[0]["title"] == "Manchete" and got[1]["errors"] == ["missing_title", "missing_published_at"]
    bytes_ = spark.createDataFrame([(200, bytearray("é", "latin-1"), {"Content-Type": "text/plain; charset=iso-8859-1", "Content-Length": "1"})], "status int, body binary, headers map<string,string>")
    back = x.normalised_responses(bytes_).first()
    assert back["body"] == "é" and back["headers"] == {"Content-Type": "text/plain; charset=iso-8859-1"} and back["needs_refetch"] is False


LISTS = [
    ("agencia_lupa", "https://l.org/", "<div class='archive-body'><article><a class='feed-link' href='/checagem/1'></a><a class='feed-link' href='/x'></a></article></div><a class='next page-numbers' href='/p2'></a>", {}, (["https://l.org/checagem/1"], ["https://l.org/p2"])),
    ("aos_fatos", "https://www.aosfatos.org/noticias/?formato=checagem&page=2", "<a href='/noticias/a'></a><a href='/noticias/?formato=checagem&page=3'></a><a href='/noticias/'></a>", {}, (["https://www.aosfatos.org/noticias/a"], ["https://www.aosfatos.org/noticias/?formato=checagem&page=3"])),
    ("e_farsas", "https://e.com/", "<div class='mvp-main-blog-text'><a href='/a'></a></div><div class='pagination'><a href='/page/2'>Seguinte</a></div>", {}, (["https://e.com/a"], ["https://e.com/page/2"])),
    ("projeto_comprova", "https://p.br/page/1/?filter=verificacao", "<a class='answer__title__link' href='/publicacoes/x'></a><div class='pagination'><a href='/page/2/?filter=verificacao'></a></div>", {}, (["https://p.br/publicacoes/x"], ["https://p.br/page/2/?filter=verificacao"])),
    ("observador", "https://observador.pt/factchecks/", "<a href='/factchecks/a'></a><div class='editorial-grid' data-offset='20260301'></div>", {}, (["https://observador.pt/factchecks/a"], ["offset=20260301"])),
    ("observador", "u", json.dumps({"rendered": {"modules": "<a href='/factchecks/b'></a><time datetime='2026-02-01'></time><time datetime='2026-01-05'></time>"}}), {"offset": "20260201"}, (["https://observador.pt/factchecks/b"], ["offset=20260105"])),
    ("afp_checamos", "https://checamos.afp.com/list", "<div data-view-dom-id='z'></div><article><a href='/doc.afp.com.1'></a><a href='/contato'></a></article>", {}, (["https://checamos.afp.com/doc.afp.com.1"], ["page=1"])),
    ("afp_checamos", "u", json.dumps([{"data": "<div class='views-row'><a href='/doc.afp.com.2'></a></div><a href='?page=4'></a>"}]), {"page": 1}, (["https://checamos.afp.com/doc.afp.com.2"], ["page=4"])),
    ("reuters_fact_check", "u", json.dumps({"result": {"articles": [{"canonical_url": "/fact-check/portugues/a/"}, {"headlines": {}, "url": "/other"}], "pagination": {"next_offset": 20}}}), {"offset": 0}, (["https://www.reuters.com/fact-check/portugues/a/"], ["offset=20"])),
    ("uol_confere", "https://n.uol.com.br/", "<section class='results-index'><a href='https://n/confere/1'></a></section><button class='ver-mais btn-more' data-request='{&quot;hasNext&quot;:true,&quot;busca&quot;:{&quot;params&quot;:{&quot;next&quot;:&quot;t1&quot;}}}'></button>", {}, (["https://n/confere/1"], ["next=t1"])),
    ("poligrafo", "https://p.pt/", "<div class='elementor-posts-container'><div><a href='/fact-check/a'></a><div class='listing-post-categories'><a href='/fact-checks/economia/'></a></div></div><div><a href='/fact-check/b'></a></div></div>", {}, (["https://p.pt/fact-check/a"], [])),
    ("estadao_verifica", "u", "<?xml version='1.0'?><urlset xmlns='http://x'><url><loc>https://e/estadao-verifica/1</loc></url><url><loc>https://e/outro</loc></url></urlset>", {}, (["https://e/estadao-verifica/1"], [])),
    ("publico", "u", "<sitemapindex><sitemap><loc>https://e/s2.xml</loc></sitemap></sitemapindex>", {}, ([], ["https://e/s2.xml"])),
    ("reuters_fact_check", "u", "{broken", {}, ([], [])), ("uol_confere", "u", "", {}, ([], [])), ("observador", "u", "just a moment", {}, ([], [])),
]


@pytest.mark.parametrize(("spider", "url", "body", "state", "expected"), LISTS)
def test_discovery(spider, url, body, state, expected):
    assert d.discover_page(spider, url, 200, body, state) == expected


def test_frontier(spark):
    listing = lambda n, nxt: f"<div class='mvp-main-blog-text'><a href='/a{n}'></a></div><div class='pagination'><a href='{nxt}'>Seguinte</a></div>"
    rows = [("e_farsas", "https://e.com/", 200, listing(1, "/2")), ("e_farsas", "https://e.com/2", 200, listing(2, "/")), ("e_farsas", "https://e.com/9", 200, listing(9, "/"))]
    responses = spark.createDataFrame(rows, "spider string, url string, status int, body string")
    seeds = responses.filter("url = 'https://e.com/'").select("spider", "url")
    assert {r["url"] for r in d.frontier(seeds, responses).collect()} == {"https://e.com/a1", "https://e.com/a2"}


def test_sitemap_in_spark(spark):
    df = spark.createDataFrame([("<urlset><url><loc>a&amp;b</loc></url></urlset>",), ("<urlset><url>",), (None,)], "body string")
    assert [r["locations"] for r in d.sitemap_locations(df).collect()] == [["a&b"], None, None]


def test_response_headers_and_charsets(spark):
    rows = [
        (200, bytearray("<html>é", "utf-8"), {"content-type": "text/plain; charset=iso-8859-1", "Content-MD5": "x", "Connection": "close"}),
        (200, bytearray("“é”", "cp1252"), {"Content-Type": "text/plain; charset=windows-1252"}),
        (200, bytearray("ж", "koi8-r"), {"Content-Type": "text/plain; charset=koi8-r; x=1"}),
        (200, bytearray("é", "latin-1"), {"Content-Type": "text/plain; charset=unknown"}),
        (200, None, None),
    ]
    got = x.normalised_responses(spark.createDataFrame(rows, "status int, body binary, headers map<string,string>")).collect()
    assert [r["body"] for r in got] == ["<html>é", "“é”", "ж", "\ufffd", None]
    assert got[0]["headers"] == {"Connection": "close", "Content-Type": "text/html; charset=utf-8"}
