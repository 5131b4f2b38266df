import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimlake.operators import multivalue as m

WORDS = ["Ana Prux", "Rui de Sá", "Eva Tenório-Sá", "Ivo Lima", "Zé Carvalho", "Núcleo de Dados", "Bia Melo"]


def run(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "arrival long, author string, tags array<string>")
    out: dict = {}
    for r in sorted(m.found(df).collect(), key=lambda r: (r["arrival"], r["field"], r["pos"])):
        out.setdefault((r["arrival"], r["field"]), []).append(r["part_text"])
    return out


def test_cases(spark):
    rows = [
        ("Ana Prux; Rui de Sá", None), ('Ana Prux,"Prux, Zenaide"', None), ("Ana Prux e Rui de Sá", ["água e esgoto", "a; b"]), ("Ana Prux", ["24/7", "x / y"]),
        ('["Ana Prux", "Ivo Lima"]', ["['a', 'b']"]), (None, None), ("", []), ("; ;", [None, ""]), ('"Odila ""Bala"" Vilarim"', None), (";Ana Prux;;Ivo Lima;", ["|a||b|"]),
        ("Ana Prux, Ivo Lima; Bia Melo & Rui de Sá", ["\ta\tb\n"]), ('"Ana Prux" | "Odila ""Bala"" Vilarim"', None), ("Ana Prux", ["so um"]),
    ]
    assert run(spark, rows) == {
        (0, "author"): ["Ana Prux", "Rui de Sá"], (1, "author"): ["Ana Prux", "Prux, Zenaide"], (2, "author"): ["Ana Prux", "Rui de Sá"], (2, "tags"): ["água e esgoto", "a", "b"],
        (3, "tags"): ["24/7", "x", "y"], (4, "author"): ["Ana Prux", "Ivo Lima"], (4, "tags"): ["a", "b"], (9, "author"): ["Ana Prux", "Ivo Lima"], (9, "tags"): ["a", "b"],
        (10, "author"): ["Ana Prux", "Ivo Lima", "Bia Melo", "Rui de Sá"], (10, "tags"): ["a", "b"], (11, "author"): ["Ana Prux", 'Odila "Bala" Vilarim'],
    }


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(WORDS), min_size=2, max_size=5), st.sampled_from([", ", ";", "|", "\t", " / ", "\n"]), st.data())
def test_split_round_trip(values, separator, data):
    """Quoted values come back whole, whatever they hold; plain ones as they were."""
    kinds = {", ": ",", ";": ";", "|": "|", "\t": "tab", " / ": "/", "\n": "line"}
    shown, real = [], []
    for v in values:
        if data.draw(st.booleans()):
            v = f'{v}{separator}"x"'
            shown.append('"' + v.replace('"', '""') + '"')
        else:
            shown.append(v)
        real.append(v)
    assert m.split(separator.join(shown), (kinds[separator],), '"') == real


def test_a_value_that_recurs_with_its_separator_is_kept_if_quoted(spark):
    rows = [(f"{random.Random(i).choice(WORDS)}; 'Dados, Prisma'", None) for i in range(20)]
    assert all(v[1] == "Dados, Prisma" for v in run(spark, rows).values())


def test_parses_lists_differing_readings_once():
    options = m.parses("a, b", word_e=False)
    assert [v for _, v in options] == [["a, b"], ["a", "b"]]
    assert m.parses("", word_e=True) == [("", [])]


def test_long_and_empty(spark):
    assert run(spark, []) == {}
    big = "; ".join(f"nome {i}" for i in range(3000))
    assert len(run(spark, [(big, None)])[(0, "author")]) == 3000


@pytest.mark.parametrize("name", ["key", "column", "text", "_p"])
def test_clashing_columns(spark, name):
    df = spark.createDataFrame([(1, "a; b", ["x"], "z")], f"arrival long, author string, tags array<string>, {name} string")
    assert m.found(df).count() == 2
