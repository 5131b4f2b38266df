"""Several values packed in one field: split into one row per value, position kept.

Method: minimum description length.  Every string with a separator is read under
all dialects that differ on it: which of its separator kinds part values, which
quote characters protect a value, whether brackets enclose a list.  A reading
costs the code lengths of its values plus its separators; a value's code length
comes from how often it is a candidate value anywhere in the column (counted
over all rows, by shuffle), or from spelling it out.  The cheapest reading wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.session import materialise

#: Separator kinds as patterns.  ``word_e`` is left out for columns in which the word joins one value.
SEPARATORS = {
    ",": r",", ";": r";", "|": r"\|", "tab": r"\t", "line": r"[\r\n]+", "dot": r"[·•]", "&": r"\s&\s",
    "/": r"\s/\s", "word_e": r"\s[eE]\s",
}

#: Bits to spell one ordinary character, one separator or quote character inside a value,
#: one separator between values, and to begin a value that has to be spelled out.
SPELL_BITS, ODD_BITS, SEPARATOR_BITS, NEW_BITS = 4.6, 16.0, 3.0, 6.0

_QUOTES = "\"'"
_CLOSED = {"“": "”", "‘": "’", "«": "»"}


def _strip(value: str, quotes: str) -> str:
    """The value without surrounding space, and without quotes that enclose it."""
    value = value.strip()
    if len(value) >= 2 and value[0] in quotes and value[-1] == value[0]:
        inner = value[1:-1]
        value = inner.replace(value[0] * 2, value[0]).strip()
    elif len(value) >= 2 and _CLOSED.get(value[0]) == value[-1] and value[-1] not in value[1:-1]:
        value = value[1:-1].strip()
    return value


def split(text: str, kinds: tuple[str, ...], quotes: str) -> list[str]:
    """The non-empty values of ``text`` if ``kinds`` part values and ``quotes`` protect them."""
    separator = re.compile("|".join(f"(?:{SEPARATORS[k]})" for k in kinds)) if kinds else None
    values, start, at, size = [], 0, 0, len(text)
    while separator is not None and at < size:
        if quotes and text[at] in quotes and not text[start:at].strip():
            q, end = text[at], at + 1
            while end < size and (text[end] != q or text[end : end + 2] == q * 2):
                end += 2 if text[end] == q else 1
            after = separator.search(text, end)
            # A quote protects only a whole value: space and a separator, or the end, must follow.
            if end < size and not text[end + 1 : after.start() if after else size].strip():
                at = end + 1
                continue
        found = separator.match(text, at)
        if found and found.end() > at:
            values.append(text[start : found.start()])
            # White space that closes one separator may open the next.
            start = at = found.end() - (found.group()[-1] == " " and found.end() < size)
            continue
        at += 1
    values.append(text[start:])
    return [v for v in (_strip(v, quotes) for v in values) if v]


def parses(text: str, word_e: bool) -> list[tuple[str, list[str]]]:
    """``(dialect, values)`` of all readings of one string that differ, the plain one first."""
    out, seen = [], set()
    bare = text.strip()
    bodies = [("", bare)]
    if len(bare) > 1 and bare[0] in "[(" and bare[-1] == {"[": "]", "(": ")"}[bare[0]]:
        bodies.append(("[]", bare[1:-1]))
    for mark, body in bodies:
        present = [k for k, rx in SEPARATORS.items() if (word_e or k != "word_e") and re.search(rx, body)]
        used = [q for q in _QUOTES if q in body]
        for chosen in chain.from_iterable(combinations(present, n) for n in range(len(present) + 1)):
            for quotes in ("".join(c) for n in range(len(used) + 1) for c in combinations(used, n)):
                values = split(body, chosen, quotes)
                key = (mark, tuple(values))
                if key not in seen:
                    seen.add(key)
                    out.append((f"{mark} {' '.join(chosen)} {quotes}".strip(), values))
    return out


_PARSES = T.ArrayType(T.StructType().add("dialect", "string").add("parts", T.ArrayType(T.StringType())))


@F.pandas_udf(_PARSES)
def _parses_udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for texts, word_e in batches:
        yield pd.Series([[{"dialect": d, "parts": v} for d, v in parses(t, e)] for t, e in zip(texts, word_e, strict=True)])


def choose_dialects(strings: DataFrame) -> DataFrame:
    """``column, text, dialect, parts`` from ``column, text, word_e, n``: each string's cheapest reading.

    ``n`` is how many rows hold the string.  Of readings of equal cost the one with
    more values wins, then the dialect's name decides.
    """
    read = materialise(
        strings.withColumn("id", F.xxhash64("column", "text")).withColumn("_p", _parses_udf("text", "word_e")), "parses"
    )
    pieces = read.select("column", "word_e", "n", F.explode(F.array_distinct(F.flatten(F.col("_p.parts")))).alias("part"))
    known = pieces.groupBy("column", "word_e", "part").agg(F.sum("n").alias("seen"))
    total = read.groupBy("column").agg(F.sum("n").alias("total"))
    odd = F.length(F.regexp_replace("part", r"[^,;|\t\r\n·•&\"'\[\]]", ""))
    odd = odd + F.regexp_count("part", F.lit(r"\s/\s")) + F.when(F.col("word_e"), F.regexp_count("part", F.lit(r"\s[eE]\s"))).otherwise(0)
    spelled = NEW_BITS + SPELL_BITS * F.length("part") + (ODD_BITS - SPELL_BITS) * odd
    coded = F.log2((F.col("total") + 1) / F.col("seen")) + 1
    # A value that was seen once is no cheaper than its spelling, and one with separator or quote characters
    # inside must be spelled out unless it recurs on its own.
    bits = F.when((F.col("seen") > 1) & (odd == 0), F.least(coded, spelled)).otherwise(spelled)
    lengths = known.join(F.broadcast(total), "column").select("column", "part", bits.alias("bits"))
    options = read.select("column", "text", "id", F.posexplode("_p").alias("option", "_o"))
    uses = options.select("column", "id", "text", "option", F.explode_outer("_o.parts").alias("part"))
    cost = (
        uses.join(lengths, ["column", "part"], "left")
        .groupBy("column", "id", "text", "option")
        .agg(F.sum(F.coalesce("bits", F.lit(0.0)) + SEPARATOR_BITS).alias("cost"), F.count("part").alias("values"))
    )
    best = cost.groupBy("column", "id", "text").agg(
        F.min(F.struct(F.round("cost", 6).alias("cost"), (-F.col("values")).alias("fewer"), "option")).alias("best")
    )
    chosen = best.join(read.select("column", "id", "text", "_p"), ["column", "id", "text"])
    picked = F.element_at("_p", F.col("best.option") + 1)
    return chosen.select("column", "text", picked["dialect"].alias("dialect"), picked["parts"].alias("parts"))


#: What any reading needs to hold several values, or to differ from the string itself.
_PACKED = r"[,;|\t\r\n·•&]|\s/\s|\s[eE]\s|^\s*[\[\"']"


def split_values(df: DataFrame, key: str, columns: dict[str, bool]) -> DataFrame:
    """``key, field, pos, part_text, several``: one row for each value of each column.

    ``columns`` maps string or array<string> columns to whether the word ``e`` parts
    their values.  ``pos`` counts from 1 through the whole array, empty values are
    skipped, ``several`` tells whether at least one string of the field holds
    several values.  Nulls, blanks and empty arrays give no row; repeated values
    and repeated rows of one ``key`` keep their places (their rows are numbered
    apart only if ``key`` differs).
    """
    longs = []
    for name, word_e in columns.items():
        kind = dict(df.dtypes)[name]
        value = F.col(f"`{name}`") if kind.startswith("array") else F.array(F.col(f"`{name}`"))
        longs.append(
            df.select(F.col(f"`{key}`").alias("key"), F.lit(name).alias("column"), F.lit(word_e).alias("word_e"), F.posexplode(value).alias("slot", "text"))
        )
    long = longs[0]
    for more in longs[1:]:
        long = long.unionByName(more)
    long = long.filter(F.length(F.trim("text")) > 0)
    packed = long.filter(F.col("text").rlike(_PACKED))
    strings = packed.groupBy("column", "text", "word_e").agg(F.count("*").alias("n"))
    chosen = choose_dialects(strings)
    plain = long.filter(~F.col("text").rlike(_PACKED)).select("key", "column", "slot", F.array(F.trim("text")).alias("parts"))
    parted = packed.select("key", "column", "slot", "text").join(chosen, ["column", "text"]).select("key", "column", "slot", "parts")
    fields = (
        plain.unionByName(parted)
        .groupBy("key", "column")
        .agg(F.array_sort(F.collect_list(F.struct("slot", "parts"))).alias("_s"))
    )
    several = F.exists("_s", lambda s: F.size(s["parts"]) > 1)
    return fields.select(
        "key", F.col("column").alias("field"), several.alias("several"), F.posexplode(F.flatten(F.col("_s.parts"))).alias("pos", "part_text")
    ).select("key", "field", (F.col("pos") + 1).cast("long").alias("pos"), "part_text", "several")


def found(items: DataFrame) -> DataFrame:
    """``arrival, field, pos, part_text`` of every author and tags field that holds several values in one string."""
    parts = split_values(items, "arrival", {"author": True, "tags": False})
    return parts.filter("several").select(F.col("key").alias("arrival"), "field", "pos", "part_text")
