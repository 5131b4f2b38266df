import hashlib
import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimlake.functions import dates, labels, text, urls

WORD = st.text(string.ascii_letters + string.digits + "-._~ *éã", min_size=0, max_size=8)


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", column(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_canonical_url_examples(spark):
    rows = [
        "https://example.com/path/?utm_source=x&b=2&a=1#frag", "HTTP://WWW.Example.com", "example.com/x", "", None, "https://e.com/a//", "https://e.com/?b&a=%20x+y&REF=1",
        "https://e.com/p?x=1&x=0&fbclid=2",
    ]
    out = values(spark, urls.canonicalize_url, rows)
    assert out[0] == "https://example.com/path?a=1&b=2"
    assert out == [urls.canonical(r) for r in rows]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(WORD, WORD, st.lists(st.tuples(WORD, WORD), max_size=4)), min_size=1, max_size=12))
def test_canonical_url_against_the_library(spark, parts):
    from urllib.parse import quote, urlencode

    rows = [f"https://{quote(h) or 'h'}.Example/{quote(p)}/?{urlencode(q)}" for h, p, q in parts]
    assert values(spark, urls.canonicalize_url, rows) == [urls.canonical(r) for r in rows]


def test_canonical_is_idempotent(spark):
    rows = ["https://e.com/a?b=c d&a=~*", "https://e.com/%7Ex/"]
    once = values(spark, urls.canonicalize_url, rows)
    assert values(spark, urls.canonicalize_url, once) == once


def test_item_id(spark):
    df = spark.createDataFrame([("a", "https://x/ç")], "a string, u string")
    assert df.select(urls.make_item_id(F.col("a"), F.col("u"))).first()[0] == hashlib.sha256("a|https://x/ç".encode()).hexdigest()


def test_join_url(spark):
    df = spark.createDataFrame([("https://e.com/a/b", "../c"), ("https://e.com/a", None), ("https://e.com", "https://f.com/x")], "b string, u string")
    assert [r[0] for r in df.select(urls.join_url("b", "u")).collect()] == ["https://e.com/c", None, "https://f.com/x"]


@pytest.mark.parametrize(
    ("raw", "stored"),
    [("caf&eacute; &amp; bar", "café & bar"), ("ﬁnance", "finance"), ("   ", None), (None, None), (" OlÃ¡\n\tMundo ", "Olá Mundo"), ("a\xa0b", "a b"), ("Ã", "Ã")],
)
def test_stored_text(raw, stored):
    assert text.stored_text(raw) == stored


def test_analysis_text_and_lists():
    assert [text.analysis_text(v) for v in ("-", "None", "N/A", "nan", " x ")] == [None, None, None, None, "x"]
    assert text.analysis_list(["Straße", "STRASSE", None, "-", "b", "B"]) == ["Straße", "b"]
    assert text.analysis_list(None) == [] and text.stored_list(None) is None
    assert text.stored_list(["a", "a", " "]) == ["a", "a"]


def test_light_repair_native_equals_python(spark):
    rows = ["OlÃ¡", "Ã", "ok", "Â©", "â€", "é", None, "日Ã¡", ""]
    assert values(spark, text.light_repair_native, rows) == [None if r is None else text.light_repair(r) for r in rows]


def test_native_text_helpers(spark):
    assert values(spark, text.squeeze, [" a \t\n b ", " ", None, "\x1cx"]) == ["a b", None, None, "x"]
    assert values(spark, text.unique_list, [["b", " a", "b", None, "", "B"], None], "array<string>") == [["b", "a", "B"], []]
    assert values(spark, text.split_keywords, [["x, y", "y,,z "], []], "array<string>") == [["x", "y", "z"], []]
    assert values(spark, text.before_colon, ["Falso: x", "sem", ": y", None]) == ["Falso", None, None, None]
    assert values(spark, text.after_colon, ["Falso: x: y", "sem", "a:", None]) == ["x: y", None, None, None]
    assert values(spark, text.is_probable_url, ["HTTPS://e.com", "https://", "e.com", None]) == [True, False, False, False]
    assert values(spark, text.is_date_placeholder, [" – ", "-", "—", "x", None]) == [True, True, True, False, False]
    assert values(spark, lambda c: text.claim_without_verdict_suffix(c), ["Coisa Falso", "Verdade, mas", "x Verdade mas"]) == ["Coisa", "Verdade, mas", "x"]
    assert values(spark, lambda c: text.claim_without_tag(c, F.lit("s")), ["Cura #boato", None]) == ["Cura", "s"]
    assert values(spark, lambda c: text.claim_without_verdict_prefix(c, F.lit("FAKE")), ["É #FAKE que a lua caiu", "É fato que x"]) == ["a lua caiu", "É fato que x"]


def test_label_key():
    assert text.label_key("Pimenta na Língua") == "pimenta_na_lingua"
    assert text.label_key("Verdade, mas…") == "verdade_mas"
    assert text.label_key("Enganoso: x") == "enganoso:_x" and text.label_key(None) is None


@pytest.mark.parametrize(
    ("label", "expected"),
    [
        ("FAKE", "false"), ("FATO", "true"), ("Enganoso: texto", "misleading"), ("Pimenta na Língua", "satire"), ("Verdade, mas", "other"), ("VERDADE", "other"),
        ("https://x.example/1", "other"), ("123", "other"), (None, "missing"), ("Sem provas", "unverified"), ("Falso: x", "other"), ("Contextualizando: a", "misleading"),
    ],
)
def test_standard_label(spark, label, expected):
    df = spark.createDataFrame([(label,)], "v string").withColumn("k", text.label_key_of(F.col("v")))
    assert df.select(labels.standard_label(F.col("v"), F.col("k"), F.col("v"), F.col("k"))).first()[0] == expected


def test_infer_verdict(spark):
    rows = ["É falso que", "não é verdade", "nao e verdade", "Verdade, mas falta", "impreciso", "tem razão", "fakenews", "falsoã", None]
    assert values(spark, labels.infer_verdict, rows) == ["Falso", "Verdadeiro", "Falso", "Verdade, mas", "Impreciso", "Verdadeiro", None, None, None]
    assert values(spark, lambda c: labels.infer_verdict(c, strict_labels=True), ["não é verdade"]) == ["Falso"]


@pytest.mark.parametrize(
    ("raw", "iso"),
    [
        ("2026-03-11T10:00:00Z", "2026-03-11T10:00:00+00:00"), ("2026-03-11", "2026-03-11T00:00:00+00:00"), ("Wed, 11 Mar 2026 10:00:00 GMT", "2026-03-11T10:00:00+00:00"),
        ("2026-03-11T10:00:00.5-03:00", "2026-03-11T13:00:00.500000+00:00"), ("-", None), ("ontem", None), (None, None), ("0001-01-01T00:00:00+05:00", None),
    ],
)
def test_published_iso(raw, iso):
    assert dates.published_iso(raw) == iso


def test_portuguese_date(spark):
    rows = ["4 de Março de 2026 às 10:05", "11 de Marco de 2026 as 9:00", "1 de foo de 2026", "ontem", None, "31 de dezembro de 2025"]
    assert values(spark, dates.portuguese_date, rows) == ["2026-03-04T10:05:00", "2026-03-11T9:00:00", "1 de foo de 2026", "ontem", None, "2025-12-31T00:00:00"]
