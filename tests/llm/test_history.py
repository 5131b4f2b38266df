import random

import pytest

from claimlake.llm import history as h

SLUGS = ["checamos-se-vacina-contra-a-dengue-esconde-um-rastreador-em-vila-mupetosi", "video-de-campo-belo-nao-mostra-que-a-ponte-estaiada-foi-vendida", "o-que-se-sabe-sobre-a-nuvem-de-gafanhotos-em-serra-dilo"]
BASE = "https://www.site.example/boatos/"


def run(spark, items, seen=()):
    a = spark.createDataFrame([(n, "ag", i, u) for n, (i, u) in enumerate(items)], "arrival long, agency_id string, item_id string, canonical_url string")
    b = spark.createDataFrame([("ag", i, u) for i, u in seen], "agency_id string, item_id string, canonical_url string")
    return {r["arrival"]: r["accepted_item_id"] for r in h.found(a, b).collect()}


def test_ways_to_write_one_address(spark):
    s = SLUGS[0]
    variants = [
        BASE + s, f"http://m.site.example/boatos/{s}/", f"HTTPS://WWW.SITE.EXAMPLE/fatos/{s}?utm_source=x#topo", f"{BASE}{s.replace('c', '%63', 1)}.html", f"{BASE}{s}-atualizado", f"{BASE}{s.replace('dengue', 'degnue')}",
        f"{BASE}{s.replace('esconde', 'que-esconde')}", f"{BASE}{s.removesuffix('-mupetosi')}", f"https://amp.site.example/m/boatos/{s}?ref=1",
    ]
    got = run(spark, [(f"i{n}", u) for n, u in enumerate(variants)])
    assert got == dict.fromkeys(range(1, len(variants)), "i0")


def test_other_articles_stay(spark):
    s = SLUGS[0]
    rows = [BASE + s, BASE + s.replace("mupetosi", "rafolune"), f"{BASE}{s}-e-em-barra-nova", BASE + s + "-100", BASE + s + "-101", BASE + s + "?id=7", BASE + SLUGS[1], BASE + SLUGS[2]]
    assert run(spark, [(f"i{n}", u) for n, u in enumerate(rows)]) == {}


def test_history_goes_first_and_ids_link(spark):
    s = SLUGS[1]
    got = run(spark, [("new", BASE + s), ("old", BASE + "x-y-z-outra-coisa-qualquer"), ("again", BASE + s + ".html")], seen=[("acc", BASE + s), ("acc", BASE + s), ("old", BASE + "bem-diferente")])
    assert got == {0: "acc", 1: "old", 2: "acc"}


def test_agencies_are_apart_and_odd_rows_pass(spark):
    a = spark.createDataFrame([(1, "a", "x", BASE + SLUGS[0]), (2, "b", "y", BASE + SLUGS[0]), (3, None, None, None), (4, "a", "", ""), (5, "a", None, "http://[bad"), (6, "a", "z", "u" * 60000)], "arrival long, agency_id string, item_id string, canonical_url string")
    assert h.found(a, a.select("agency_id", "item_id", "canonical_url").limit(0)).count() == 0
    assert h.found(a.limit(0), a.select("agency_id", "item_id", "canonical_url")).count() == 0


def test_against_brute_force(spark):
    """Random names with one edit each: every pair of equal numbers one edit apart is linked."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(2, 5)))
    names = ["-".join(word() for _ in range(8)) for _ in range(40)]
    rows = []
    for n in names:
        k = rng.randrange(3, len(n) - 3)
        rows += [n, n[:k] + n[k + 1 :] if n[k] != "-" else n]
    got = run(spark, [(f"i{i}", BASE + r) for i, r in enumerate(rows)])
    want = {i: f"i{i - 1}" for i in range(1, len(rows), 2)}
    assert sum(got.get(i) == w for i, w in want.items()) >= 0.95 * len(want) and set(got.values()) <= {f"i{i}" for i in range(0, len(rows), 2)}


def test_dense_groups_find_spellings(spark):
    """More than the limit of names that differ in one word alone: only spellings of one word meet."""
    stem = "checamos-se-pilula-de-vinagre-cura-anemia-em-tres-dias-em-vila-"
    places = [f"{a}{b}{c}tu" for a in ("ba", "ce", "di") for b in ("fo", "gu", "la") for c in ("mi", "no", "pe")]
    rows = [BASE + stem + p for p in places] + [BASE + stem + places[4][:3] + places[4][4:]]
    got = run(spark, [(f"i{i}", r) for i, r in enumerate(rows)])
    assert got.get(len(places)) == "i4"


def test_dense_groups_find_cuts_and_swaps(spark):
    """Cut ends and swapped characters are found however many names share the beginning."""
    stem = "checamos-se-pilula-de-vinagre-cura-anemia-em-tres-dias-em-vila-"
    places = [f"{a}{b}{c}tu" for a in ("ba", "ce", "di") for b in ("fo", "gu", "la") for c in ("mi", "no", "pe")]
    rows = [BASE + stem + p for p in places] + [f"{BASE}{stem}{p}-zulmira{'-antiga' * (n % 2)}" for n, p in enumerate(places)] + [BASE + stem + "tagunobu"]
    got = run(spark, [(f"i{i}", r) for i, r in enumerate(rows)])
    assert got == {len(places) + n: f"i{n}" for n in range(len(places))} | {2 * len(places): "i4"}


def test_index_is_persistent(spark, tmp_path):
    index = h.ChunkIndex(spark, f"file://{tmp_path}/index")
    rows = lambda pairs: h.records(spark.createDataFrame([("a", i, BASE + u, n) for n, (i, u) in enumerate(pairs)], "s string, i string, u string, n int"), "s", "i", "u", "n")
    index.append(rows([("one", SLUGS[0])]))
    index.append(rows([("two", SLUGS[1])]))
    again = h.ChunkIndex(spark, f"file://{tmp_path}/index")
    assert again.batches == 2
    batch = spark.createDataFrame([("a", "n1", BASE + SLUGS[1].replace("vendida", "vendidda"), 10), ("a", "n2", BASE + SLUGS[2], 11)], "s string, i string, u string, n int")
    got = {r["record"]: r["accepted"] for r in again.check(h.records(batch, "s", "i", "u", "n")).collect()}
    assert got == {"n1": "two", "n2": None}


def test_rows_without_agency_share_a_scope(spark):
    a = spark.createDataFrame([(1, None, "x", BASE + SLUGS[0]), (2, "", "y", BASE + SLUGS[0])], "arrival long, agency_id string, item_id string, canonical_url string")
    b = spark.createDataFrame([(None, "acc", BASE + SLUGS[0])], "agency_id string, item_id string, canonical_url string")
    assert {tuple(r) for r in h.found(a, b).collect()} == {(1, "acc"), (2, "acc")}


@pytest.mark.parametrize("at", range(5, 60, 7))
def test_a_change_moves_only_near_chunks(at):
    data = b"checamos-se-vacina-contra-a-dengue-esconde-um-rastreador-em-vila"
    changed = data[:at] + b"Q" + data[at + 1 :]
    a, b = set(h.chunk_ends(data)), set(h.chunk_ends(changed))
    assert all(at < e <= at + 5 for e in a ^ b)


def test_listing_and_rests_find_the_same(spark):
    """However few records of a chunk are listed one by one, the answers are the same."""
    rng = random.Random(7)
    stem = "checamos-se-pilula-de-vinagre-cura-anemia-em-tres-dias-em-vila-"
    names = [stem + "".join(rng.choice("bcdfglm") + rng.choice("aeiou") for _ in range(4)) for _ in range(40)]
    names += [n[:k] + n[k + 1 :] for n in names[:20] for k in (rng.randrange(10, len(n) - 1),)]
    df = spark.createDataFrame([("a", f"i{i}", BASE + n, i) for i, n in enumerate(names)], "s string, i string, u string, n int")
    answers = []
    for listed in (1, 10**6):
        index = h.ChunkIndex(spark, listed=listed)
        answers.append({(r["record"], r["accepted"]) for r in index.check(h.records(df, "s", "i", "u", "n")).collect()})
    assert answers[0] == answers[1] and sum(a is not None for _, a in answers[0]) >= 15


def test_a_small_batch_moves_no_more_beside_a_larger_history(spark):
    """Rows written to shuffles by a batch of a few rows, beside a history and one ten times as large."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(2, 5)))
    slug = lambda: "-".join(word() for _ in range(8))
    rows = lambda slugs, at: h.records(spark.createDataFrame([("a", f"i{at + n}", BASE + s, at + n) for n, s in enumerate(slugs)], "s string, i string, u string, n int"), "s", "i", "u", "n")
    known = [slug() for _ in range(2000)]
    batch = [k[:9] + k[10:] for k in known[:8]] + [slug() for _ in range(8)]

    def stages() -> dict[int, int]:
        store = spark.sparkContext._jsc.sc().statusStore()
        kept = store.stageList(None, False, False, spark._sc._gateway.new_array(spark._jvm.double, 0), None)
        return {kept.apply(i).stageId(): kept.apply(i).shuffleWriteRecords() for i in range(kept.size())}

    took = []
    for size in (200, 2000):
        index = h.ChunkIndex(spark)
        index.append(rows(known[:size], 0))
        checked = rows(batch, 10_000)
        before = max(stages())
        assert index.check(checked).filter("accepted is not null").count() == 8
        took.append(sum(n for i, n in stages().items() if i > before))
    assert took[1] <= 1.3 * took[0]
