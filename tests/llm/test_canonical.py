import random

import pytest

from claimlake.llm import canonical as c

LABELS = [(1, "Falso", "verdict", ["mentira", "boato"]), (2, "Verdadeiro", "verdict", ["procede"]), (3, "Fora de contexto", "verdict", None), (4, "Verdadeiro com ressalvas", "verdict", ["quase certo"]), (5, "Risco baixo", "rating", ["2 de 5"]), (6, "Risco alto", "rating", ["4 de 5"])]


def run(spark, values, field="verdict"):
    labels = spark.createDataFrame(LABELS, "label_id long, label string, field string, aliases array<string>")
    df = spark.createDataFrame([(i, v if field == "verdict" else None, v if field == "rating" else None) for i, v in enumerate(values)], "arrival long, verdict string, rating string")
    got = {r["arrival"]: r["label_id"] for r in c.found(df, labels).collect()}
    return [got.get(i) for i in range(len(values))]


def test_spellings(spark):
    values = [
        "falso", "FALSO!", "Fallso ❌", "Selo FALSO", "É boato", "<b>Mentira</b>", "#ForaDeContexto", "fora_de_contexto - lei nem foi votada", "Veredito: foar de contexto", "quase  ceerto: vídeo é de outro ano",
        "Verdadeiro com ressal.", "verdadeiros", "Podcast 12", "https://selo.example/i/2", "Não procede", "Falso", None, " ", "-", "N/A", "null", "Falso", "xx",
    ]
    assert run(spark, values) == [1, 1, 1, 1, 1, 1, 3, 3, 3, 4, 4, 2, 0, 0, 0, None, None, None, None, None, None, None, 0]
    assert run(spark, ["2-de-5", "3 de 5", "#4De5", "risco alo", "Falso", "RISCO BAIXO"], "rating") == [5, 0, 6, 6, 0, 5]


def test_against_brute_force(spark):
    """One typing error per value: the nearest entry over all entries is the one found."""
    rng = random.Random(5)
    phrases = [(i, p) for i, label, f, aliases in LABELS if f == "verdict" for p in [label, *(aliases or [])]]
    values, want = [], []
    for _ in range(60):
        i, p = rng.choice(phrases)
        k = rng.randrange(1, len(p))
        bad = rng.choice([p[:k] + p[k + 1 :], p[:k] + p[k] + p[k:], p[: k - 1] + p[k] + p[k - 1] + p[k + 1 :]])
        if bad == p or c.distance(c.unaccented(bad), c.unaccented(p)) > 1:
            continue
        best = min((c.distance(c.unaccented(bad).replace(" ", ""), c.unaccented(q).replace(" ", "")), j) for j, q in phrases)
        values.append(bad)
        want.append(best[1])
    assert run(spark, values) == [w if v not in {label for _, label, _, _ in LABELS} else None for v, w in zip(values, want, strict=True)]


@pytest.mark.parametrize(("a", "b", "d"), [("", "abc", 3), ("abc", "abc", 0), ("ab", "ba", 1), ("kitten", "sitting", 3), ("ca", "abc", 3)])
def test_distance(a, b, d):
    assert c.distance(a, b) == c.distance(b, a) == d


def test_empty_and_clashing(spark):
    labels = spark.createDataFrame(LABELS, "label_id long, label string, field string, aliases array<string>")
    df = spark.createDataFrame([(1, "falsso", None, "z", "y")] * 2, "arrival long, verdict string, rating string, field string, label_id string")
    assert [r["label_id"] for r in c.found(df, labels).collect()] == [1, 1]
    assert c.found(df.limit(0), labels).count() == 0 and c.found(df, labels.limit(0)).first()["label_id"] == 0
