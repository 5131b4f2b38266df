"""Evaluation texts inside a training corpus: which documents hold which test items, and their removal.

Method: a broadcast hash set of the normalised word n-grams of the test items; the
corpus is scanned window by window, a hit is verified word for word (the set holds
the n-grams themselves), and spans or documents are removed.  The set is broadcast
only while it stays below a stated number of words; beyond it the n-grams are a
table, windows are joined to it by hash, and the hits are verified on the texts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.session import materialise

#: Words in a row that make a leak, and the most words of test items whose n-grams are broadcast: an n-gram takes about
#: 350 bytes in a Python worker, so the set stays below 90 MB.
WORDS, BROADCAST_LIMIT = 13, 250_000

_WORD = re.compile(r"[^\W_]+")
_MARKS = re.compile("[̀-ͯ᪰-᫿᷀-᷿⃐-⃿]+")


def plain(text: str) -> str:
    """Lower case without accents."""
    if text.isascii():
        return text.lower()
    return _MARKS.sub("", unicodedata.normalize("NFD", text.lower()))


def words(text: str | None) -> list[str]:
    """The text's words, compared without case and accents; everything but letters and digits separates them."""
    return _WORD.findall(plain(text)) if text else []


def places(text: str) -> list[tuple[int, int]]:
    """``(start, end)`` in characters of each of ``words(text)`` within the text as it stands; marks belong to the letter before them."""
    owners: list[int] = []
    made: list[str] = []
    for i, c in enumerate(text):
        for p in plain(c):
            owners.append(i)
            made.append(p)
    out = []
    for m in _WORD.finditer("".join(made)):
        end = owners[m.end() - 1] + 1
        while end < len(text) and _MARKS.fullmatch(text[end]):
            end += 1
        out.append((owners[m.start()], end))
    return out


def grams_of(items: list[tuple[int, str | None]], n: int) -> tuple[dict[tuple[str, ...], tuple[int, ...]], frozenset[str]]:
    """From each n-gram to the items that hold it, and all words of the items."""
    grams: dict[tuple[str, ...], set[int]] = {}
    vocabulary: set[str] = set()
    for key, text in items:
        w = words(text)
        vocabulary.update(w)
        for i in range(len(w) - n + 1):
            grams.setdefault(tuple(w[i : i + n]), set()).add(key)
    return {g: tuple(sorted(k)) for g, k in grams.items()}, frozenset(vocabulary)


def scan(text: str | None, grams: dict, vocabulary: frozenset[str], n: int) -> dict[int, list[tuple[int, int]]]:
    """From each leaked item to the word ranges (first, past the last) that it shares with the text."""
    w = words(text)
    hits: dict[int, list[tuple[int, int]]] = {}
    run = 0
    for i, word in enumerate(w):
        # A window can only be in the set if all its words are.
        run = run + 1 if word in vocabulary else 0
        if run >= n:
            for key in grams.get(tuple(w[i - n + 1 : i + 1]), ()):
                spans = hits.setdefault(key, [])
                if spans and spans[-1][1] >= i - n + 1:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((i - n + 1, i + 1))
    return hits


def _hits(text: str | None, grams: dict, vocabulary: frozenset[str], n: int) -> list[dict]:
    """The leaks of one text, with their places in words and in characters."""
    hits = scan(text, grams, vocabulary, n)
    at = places(text) if hits else []
    return [{"item": k, "first": a, "past": b, "start": at[a][0], "end": at[b - 1][1]} for k, spans in hits.items() for a, b in spans]


_HITS = T.ArrayType(T.StructType().add("item", "long").add("first", "integer").add("past", "integer").add("start", "long").add("end", "long"))


def leaks(documents: DataFrame, key: str, text: str, tests: DataFrame, test_key: str, passage: str, *, n: int = WORDS, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``key, item, first, past, start, end``: each stretch of at least ``n`` words that a document shares with a test item.

    ``first`` and ``past`` count words of the document from 0, ``start`` and ``end`` characters of its text.  Null, empty and shorter
    texts and passages leak nothing; passages that occur under two keys are reported
    under both.
    """
    size = tests.select(F.sum(F.greatest(F.size(F.split(F.col(f"`{passage}`"), r"\s+")), F.lit(0)))).first()[0] or 0
    if size <= limit:
        rows = tests.select(test_key, passage).collect()
        held = documents.sparkSession.sparkContext.broadcast(grams_of([(r[0], r[1]) for r in rows], n))

        @F.pandas_udf(_HITS)
        def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            grams, vocabulary = held.value
            for texts in batches:
                yield pd.Series([_hits(t, grams, vocabulary, n) for t in texts])

        found = documents.select(F.col(f"`{key}`").alias("key"), F.explode(find(F.col(f"`{text}`"))).alias("h"))
        return found.select("key", "h.*")
    return _joined_leaks(documents, key, text, tests, test_key, passage, n)


def _joined_leaks(documents: DataFrame, key: str, text: str, tests: DataFrame, test_key: str, passage: str, n: int) -> DataFrame:
    """The same for test sets of any size, by a join on window hashes."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def windows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for t in texts:
                w = words(t)
                out.append([xxhash.xxh3_64_intdigest("\x00".join(w[i : i + n])) - 2**63 for i in range(len(w) - n + 1)])
            yield pd.Series(out)

    @F.pandas_udf(_HITS)
    def verify(texts: pd.Series, keys: pd.Series, passages: pd.Series) -> pd.Series:
        out = []
        for t, k, p in zip(texts, keys, passages, strict=True):
            out.append(_hits(t, *grams_of([(k, p)], n), n))
        return pd.Series(out)

    docs = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    items = tests.select(F.col(f"`{test_key}`").alias("item"), F.col(f"`{passage}`").alias("passage"))
    left = docs.select("key", F.explode(F.array_distinct(windows("text"))).alias("gram"))
    right = items.select("item", F.explode(F.array_distinct(windows("passage"))).alias("gram"))
    pairs = materialise(left.join(right, "gram").select("key", "item").distinct(), "pairs")
    checked = pairs.join(docs, "key").join(items, "item").select("key", F.explode(verify("text", "item", "passage")).alias("h"))
    return checked.select("key", "h.*")


@F.pandas_udf(T.StringType())
def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, found in zip(texts, spans, strict=True):
        if found is None or text is None:
            out.append(text)
            continue
        for s in sorted(found, key=lambda s: -s["start"]):
            text = text[: s["start"]] + text[s["end"] :]
        out.append(text)
    return pd.Series(out)


def without_leaks(documents: DataFrame, key: str, text: str, tests: DataFrame, test_key: str, passage: str, *, whole: bool = False, n: int = WORDS) -> DataFrame:
    """The corpus without the leaked spans, or (``whole``) without the documents that hold any."""
    found = leaks(documents, key, text, tests, test_key, passage, n=n)
    if whole:
        bad = found.select("key").distinct()
        return documents.join(bad, documents[key] == bad["key"], "left_anti")
    # Spans of several items may overlap; they are merged before cutting.
    merged = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "end"))),
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    spans = found.groupBy("key").agg(merged.alias("_spans"))
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    joined = documents.select(row, F.col(f"`{key}`").alias("_own")).join(spans, F.col("_own") == F.col("key"), "left")
    value = F.col(f"_row.`{text}`")
    cleaned = F.when(F.col("_spans").isNull(), value).otherwise(_cut(value, F.col("_spans")))
    return joined.select(*[(cleaned if c == text else F.col(f"_row.`{c}`")).alias(c) for c in documents.columns])


def found(documents: DataFrame, tests: DataFrame) -> DataFrame:
    """``doc_id, eval_id``: each document and each test item of which 13 words in a row stand in it."""
    hits = leaks(documents, "doc_id", "text", tests, "eval_id", "passage")
    return hits.select(F.col("key").alias("doc_id"), F.col("item").alias("eval_id")).distinct()


FOUND_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(strip_accents(text)), '[\p{L}\p{N}]+') AS w FROM documents),
e AS (SELECT eval_id, regexp_extract_all(lower(strip_accents(passage)), '[\p{L}\p{N}]+') AS w FROM eval_items),
dg AS (SELECT doc_id, array_to_string(w[i:i + 12], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
eg AS (SELECT DISTINCT eval_id, array_to_string(w[i:i + 12], ' ') AS gram FROM (SELECT eval_id, w, unnest(range(1, len(w) - 11)) AS i FROM e))
SELECT DISTINCT doc_id, eval_id FROM dg JOIN eg USING (gram)
"""
