import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimlake.llm import packing as p


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), min_size=1, max_size=15))
def test_plan_holds_every_item_once(histogram):
    plan = p.plan(histogram, 60)
    held: Counter = Counter()
    for config, n in plan:
        assert sum(a * b for a, b in config.items()) <= 60
        held.update({a: b * n for a, b in config.items()})
    assert held == Counter(histogram)
    used, low = sum(n for _, n in plan), math.ceil(sum(a * b for a, b in histogram.items()) / 60)
    assert low <= used <= sum(n for _, n in p.best_fit(Counter(histogram), 60))


def test_near_the_lower_bound_where_best_fit_fails():
    """Thirds and sixths with awkward sizes: the program stays within two per cent of the bound."""
    histogram = {51: 600, 27: 600, 22: 600, 40: 300, 35: 300, 25: 300}
    low = math.ceil(sum(a * b for a, b in histogram.items()) / 100)
    assert sum(n for _, n in p.plan(histogram, 100)) <= 1.02 * low


def test_knapsack_against_brute_force():
    import itertools

    import numpy as np

    lengths, prices = np.array([3, 5, 7]), np.array([2.0, 4.1, 5.0])
    best = max((sum(n * v for n, v in zip(c, prices)) for c in itertools.product(range(6), repeat=3) if sum(n * w for n, w in zip(c, lengths)) <= 16))
    assert sum(prices[k] * n for k, n in p.knapsack(lengths, prices, 16).items()) == pytest.approx(best)


def test_pack_in_spark(spark):
    rows = [(i, 10 + i % 7) for i in range(200)] + [(500, 250), (501, 0), (502, None), (503, 100), (503, 100)]
    out = p.pack(spark.createDataFrame(rows, "doc long, tokens long"), "doc", "tokens", capacity=100).collect()
    load: Counter = Counter()
    for r in out:
        load[r["container"]] += r["length"]
    assert max(load.values()) <= 100 and set(load) == set(range(len(load)))
    assert sorted((r["piece"], r["start"], r["length"]) for r in out if r["key"] == 500) == [(0, 0, 100), (1, 100, 100), (2, 200, 50)]
    assert len([r for r in out if r["key"] == 503]) == 2 and not [r for r in out if r["key"] in (501, 502)] and Counter(r["key"] for r in out if r["key"] < 200) == Counter(range(200))
    assert len(load) <= math.ceil(sum(load.values()) / 100) + 2
    empty = p.pack(spark.createDataFrame([], "doc long, tokens long"), "doc", "tokens", capacity=100)
    assert empty.count() == 0
    with pytest.raises(ValueError, match="capacity"):
        p.pack(empty, "doc", "tokens", capacity=0)


def test_tokens(spark):
    import os

    if not os.path.exists(p.TOKENIZER):
        pytest.skip("no vocabulary file")
    df = spark.createDataFrame([("Olá, mundo",), (None,), ("",), ("a " * 20000,)], "text string")
    got = [r[0] for r in df.select(p.token_count(df["text"])).collect()]
    assert got[0] == len(p.encoder(p.TOKENIZER).encode_ordinary("Olá, mundo")) and got[1:3] == [0, 0] and got[3] >= 20000


def item_by_item(histogram, capacity):
    boxes = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            room = [b for b in boxes if b >= length]
            if room:
                boxes.remove(min(room))
            boxes.append((min(room) if room else capacity) - length)
    return len(boxes)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 30), min_size=1, max_size=12))
def test_best_fit_on_counts_is_best_fit_item_by_item(histogram):
    got = p.best_fit(Counter(histogram), 30)
    held: Counter = Counter()
    for config, n in got:
        assert sum(a * b for a, b in config.items()) <= 30
        held.update({a: b * n for a, b in config.items()})
    assert held == Counter(histogram) and sum(n for _, n in got) == item_by_item(histogram, 30)


def test_a_hundred_million_items_are_planned_by_their_histogram():
    histogram = {n: 50_000 + n for n in range(1, 2049)}
    plan = p.best_fit(Counter(histogram), 2048)
    low = math.ceil(sum(a * b for a, b in histogram.items()) / 2048)
    assert len(plan) < 20_000 and low <= sum(n for _, n in plan) <= 1.01 * low
