"""Texts put into containers of one fixed capacity (in tokens) with little space left over.

Method: a configuration linear program over the histogram of lengths.  A
configuration is a multiset of lengths that fits one container; the program uses
as few containers as cover all lengths.  Multiplicative weights solve it: every
length has a price, a knapsack dynamic program finds the best configuration at
these prices, the configuration takes a step, and the prices of the lengths it
covers fall.  The solution is rounded down to whole containers; what is left over,
a few items per configuration, goes into best-fit-decreasing containers.  The
driver sees the histogram alone, whose size is bounded by the capacity; the items
are laid into the plan by their rank within their length, in parallel.
"""

from __future__ import annotations

import base64
import bisect
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.session import materialise

#: Where a vocabulary file lies, tokens of a container, and the largest capacity (it bounds the histogram).
TOKENIZER, CAPACITY, MAX_CAPACITY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken", 2048, 65_536

#: Pricing steps, the share of the scarcest length that one step takes, and how fast prices fall.
STEPS, STEP, RATE = 600, 0.25, 0.5

# Fixed value: the published split pattern of the byte-level vocabularies.
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoder(path: str):  # noqa: ANN201
    """The tokenizer of a rank file, once per worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    return tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, path: str = TOKENIZER) -> Column:
    """Tokens of a text; 0 for null and empty ones."""

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = encoder(path)
        for texts in batches:
            yield pd.Series([len(tokens.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return count(text)


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> Counter:
    """The multiset of lengths within the capacity whose prices add up to most; ``lengths`` ascend."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if fits[c]:
            gain = best[c - lengths[: fits[c]]] + prices[: fits[c]]
            k = int(gain.argmax())
            if gain[k] > best[c]:
                best[c], choice[c] = gain[k], k
    found, c = Counter(), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            found[int(choice[c])] += 1
            c -= int(lengths[choice[c]])
    return found


def solve(histogram: dict[int, int], capacity: int) -> list[tuple[Counter, float]]:
    """Configurations (length to count) and how often each is used, by multiplicative weights; nothing is used up twice."""
    lengths = np.array(sorted(histogram), dtype=int)
    number = np.array([histogram[n] for n in lengths], dtype=float)
    left, price = number.copy(), lengths / capacity
    used: dict[tuple, float] = {}
    for _ in range(STEPS):
        open_ = np.flatnonzero(left >= 1)
        if not len(open_):
            break
        config = knapsack(lengths[open_], price[open_], capacity)
        if not config:
            break
        config = Counter({int(open_[k]): n for k, n in config.items()})
        rows = np.fromiter(config.keys(), int)
        times = np.fromiter(config.values(), float)
        # More of a length than is left can't be taken; the configuration keeps what there is.
        times = np.minimum(times, np.floor(left[rows]))
        rows, times = rows[times > 0], times[times > 0]
        step = float(max(1.0, np.floor((STEP * left[rows] / times).min())))
        step = min(step, float(np.floor((left[rows] / times).min())))
        left[rows] -= step * times
        price[rows] *= np.exp(-RATE * step * times / number[rows])
        key = tuple(sorted((int(lengths[r]), int(t)) for r, t in zip(rows, times, strict=True)))
        used[key] = used.get(key, 0.0) + step
    return [(Counter(dict(k)), x) for k, x in used.items()]


def best_fit(histogram: Counter, capacity: int) -> list[tuple[Counter, int]]:
    """Best-fit-decreasing over the histogram: ``(configuration, containers)``.

    Containers filled alike are one entry with a count, so time and memory follow the
    different lengths and fillings, not the items.
    """
    # From each space that is left to the fillings that leave it, with how many containers there are of each.
    free: dict[int, Counter] = {capacity: Counter()}
    spaces = [capacity]  # ascending

    def put(filling: tuple, space: int, boxes: int) -> None:
        if space not in free:
            free[space] = Counter()
            bisect.insort(spaces, space)
        free[space][filling] += boxes

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            # The fullest container that still takes the length; it stays the fullest until it takes no more.
            space = spaces[bisect.bisect_left(spaces, length)]
            each = space // length
            if free[space]:
                filling, boxes = next(iter(free[space].items()))
            else:
                filling, boxes = (), -(-left // each)  # new containers; the one space without any is the whole capacity
            used = min(boxes, left // each)
            times = each if used else left
            used = used or 1
            if filling:
                free[space][filling] -= used
                if not free[space][filling]:
                    del free[space][filling]
                    if not free[space] and space != capacity:
                        del free[space], spaces[bisect.bisect_left(spaces, space)]
            put((*filling, (length, times)), space - times * length, used)
            left -= used * times
    return [(Counter(dict(filling)), boxes) for fillings in free.values() for filling, boxes in fillings.items()]


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """``(configuration, containers)`` that hold every item of the histogram exactly once."""
    if any(n > capacity or n < 1 for n in histogram):
        raise ValueError("lengths must lie between 1 and the capacity")
    left, out = Counter(histogram), []
    for config, x in sorted(solve(histogram, capacity), key=lambda c: -c[1]):
        fill = sum(n * t for n, t in config.items()) / capacity
        whole = min([int(x), *(left[n] // t for n, t in config.items())])
        # A container that the program left half empty is better filled anew with what remains.
        if whole > 0 and fill >= 0.98:
            out.append((config, whole))
            for n, t in config.items():
                left[n] -= whole * t
    out += best_fit(+left, capacity)
    # The plain plan is another feasible one; the better is taken.
    plain = best_fit(Counter(histogram), capacity)
    return min(out, plain, key=lambda plan_: sum(n for _, n in plan_))


def pack(df: DataFrame, key: str, tokens: str, capacity: int = CAPACITY) -> DataFrame:
    """``key, piece, start, length, container`` from rows with a number of tokens.

    A row of more tokens than the capacity is split into full pieces and one rest;
    no other is.  Rows of null or no tokens go nowhere and give no row.  Keys may
    repeat: each row is an item.  Containers are numbered from 0.
    """
    if not 1 <= capacity <= MAX_CAPACITY:
        raise ValueError(f"capacity must lie between 1 and {MAX_CAPACITY}")
    n = F.col(f"`{tokens}`")
    starts = F.sequence(F.lit(0).cast("long"), n - 1, F.lit(capacity).cast("long"))
    items = df.filter(n > 0).select(F.col(f"`{key}`").alias("key"), n.alias("_n"), F.posexplode(starts).alias("piece", "start"))
    items = items.select("key", "piece", "start", F.least(F.lit(capacity), F.col("_n") - F.col("start")).cast("int").alias("length"))
    items = materialise(items.withColumn("salt", F.pmod(F.xxhash64("key", "piece"), F.lit(256)).cast("short")), "items")
    groups = materialise(items.groupBy("length", "salt").agg(F.count("*").alias("n")), "groups")  # at most 256 rows a length
    histogram = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots: dict[int, tuple[list[int], list[int], list[int]]] = {}
    base = 0
    for config, count in plan(histogram, capacity):
        for length, times in config.items():
            first, per, at = slots.setdefault(length, ([0], [], []))
            per.append(times)
            at.append(base)
            first.append(first[-1] + times * count)
        base += count
    held = df.sparkSession.sparkContext.broadcast({k: tuple(map(np.array, v)) for k, v in slots.items()})

    @F.pandas_udf(T.LongType())
    def container(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        table = held.value
        for lengths, ranks in batches:
            out = np.empty(len(lengths), dtype="int64")
            for length, rows in lengths.groupby(lengths).groups.items():
                first, per, at = table[length]
                rank = ranks.loc[rows].to_numpy()
                i = np.searchsorted(first, rank, side="right") - 1
                out[lengths.index.get_indexer(rows)] = at[i] + (rank - first[i]) // per[i]
            yield pd.Series(out)

    # A rank within a length without one task per length: rank within a salted part, plus the parts before it.
    from pyspark.sql import Window

    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("key", "piece", "start")) - 1
    ranked = items.withColumn("rank", within).join(offsets, ["length", "salt"])
    placed = ranked.withColumn("container", container("length", (F.col("rank") + F.col("offset")).cast("long")))
    return placed.select("key", F.col("piece").cast("long").alias("piece"), "start", F.col("length").cast("long").alias("length"), "container")


def packed_documents(documents: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, piece, start_token, n_tokens, container`` of all documents with text."""
    sized = documents.select("doc_id", token_count(F.col("text"), tokenizer).alias("tokens"))
    out = pack(sized, "doc_id", "tokens", capacity)
    return out.select(F.col("key").alias("doc_id"), "piece", F.col("start").alias("start_token"), F.col("length").alias("n_tokens"), "container")
