"""Values typed freely, mapped to the closest entry of a reference list; unmatched values are reported.

Method: token-level repair.  The distinct tokens of all values are joined to the
reference vocabulary by edit distance (an equi-join on character trigrams finds
the candidates, none within the distance is lost), and corrected tokens are then
combined with soft TF-IDF to rank complete entries.  A value with its spaces
removed is one more token, joined to the entries with theirs removed, so that
moved, lost or added spaces don't matter.  All work is on distinct values; the
rows only take the answer back by a join.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.session import materialise

#: Edits allowed per character of the reference token, and the least similarity of words when soft TF-IDF decides.
EDITS_PER_CHARACTER, MIN_SCORE = 0.25, 0.8
#: A value that is cut short must hold this share of the entry it begins.
MIN_PREFIX = 0.6

#: Words that may open a value before the entry (a seal, a verdict) are dropped, up to this many; these never are.
MAX_LEAD, NEGATIONS = 2, ("nao", "nem", "sem", "nunca", "nada", "not", "no", "sin")

_ACCENTS = "áàâãäåéèêëíìîïóòôõöúùûüçñ", "aaaaaaeeeeiiiiooooouuuucn"


def fold(value: Column) -> Column:
    """Lower case, without accents; what joins words (``_ - .``) and camel case as spaces."""
    split = F.regexp_replace(value, r"(?<=\p{Ll})(?=\p{Lu})|(?<=\p{L})(?=\p{Nd})|(?<=\p{Nd})(?=\p{L})", " ")
    low = F.translate(F.lower(split), *_ACCENTS)
    return F.trim(F.regexp_replace(F.regexp_replace(low, r"\p{M}+", ""), r"[^\p{L}\p{Nd}]+", " "))


def distance(a: str, b: str) -> int:
    """Optimal string alignment: insert, delete, replace, or swap neighbours."""
    if a == b:
        return 0
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
    return row[-1]


def similarity(token: str, entry: str, cut: bool) -> float:
    """1 for equal tokens, 0 beyond the allowed edits; digits must agree.

    ``cut`` says that the token ends in a full stop, so it may be a shorter beginning.
    """
    if [c for c in token if c.isdigit()] != [c for c in entry if c.isdigit()]:
        return 0.0
    if token[-1:] == "s" and entry[-1:] != "s" and len(entry) > 3 and token[:-1] != entry:
        token = token[:-1]  # a plural is no edit
    allowed = max(1, int(len(entry) * EDITS_PER_CHARACTER)) if len(entry) > 3 else 0
    if abs(len(token) - len(entry)) <= allowed:
        d = distance(token, entry)
        if d <= allowed:
            return 1.0 - d / (len(entry) + 1)
    least = 0.4 if cut else MIN_PREFIX
    if len(token) >= max(3, least * len(entry)) and len(token) < len(entry):
        d = distance(token, entry[: len(token)])
        if d <= max(0, int(len(token) * EDITS_PER_CHARACTER) - 1) or d == 0:
            return 0.95 - 0.3 * (1 - len(token) / len(entry)) - d / (len(entry) + 1)
    return 0.0


@F.pandas_udf(T.DoubleType())
def _similarity(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for tokens, entries, cuts in batches:
        yield pd.Series([similarity(t, e, c) for t, e, c in zip(tokens, entries, cuts, strict=True)], dtype="float64")


def _trigrams(token: Column) -> Column:
    padded = F.concat(F.lit("  "), token, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(token) + 1), lambda i: F.substring(padded, i, F.lit(3))))


def _phrases(reference: DataFrame) -> DataFrame:
    """``field, label_id, phrase``: every label and alias once."""
    both = F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")))
    return reference.select("field", "label_id", F.explode(both).alias("raw")).select("field", "label_id", fold(F.col("raw")).alias("phrase")).filter("phrase <> ''").distinct()


def match_values(values: DataFrame, reference: DataFrame) -> DataFrame:
    """``field, value, label_id, score`` for each distinct ``field, value`` of ``values`` (with its count ``n``).

    ``label_id`` is 0 where no entry of the field is near enough.  Of entries of
    equal score the lower ``label_id`` wins.  The entry may stand anywhere before a
    comment; earlier parts of a value go before later ones.
    """
    phrases = materialise(_phrases(reference), "phrases")
    bare = F.regexp_replace("value", r"<[^<>]{0,40}>|&[a-z#0-9]{2,8};", " ")
    parts = F.filter(F.split(bare, r"\s[-–—]\s|[:;|()\[\]\n\r\t]|//"), lambda s: s.rlike(r"[\p{L}\p{Nd}]"))
    segments = values.select("field", "value", "n", F.posexplode(parts).alias("part", "raw")).select(
        "field", "value", "n", "part", fold(F.col("raw")).alias("text"), F.col("raw").rlike(r"[\p{L}\p{Nd}](\.|…)+[^\p{L}\p{Nd}]*$").alias("cut")
    )
    segments = materialise(segments.filter("text <> ''"), "segments")
    words = F.array_distinct(F.split("text", " "))
    # The value without its spaces, whole and without up to MAX_LEAD opening words.
    listed = F.split("text", " ")
    leads = F.filter(
        F.transform(F.sequence(F.lit(0), F.least(F.lit(MAX_LEAD), F.size(listed) - 1)), lambda k: F.struct(k.alias("lead"), F.array_join(F.slice(listed, k + 1, F.size(listed)), "").alias("token"))),
        lambda s: ~F.arrays_overlap(F.slice(listed, F.lit(1), s["lead"]), F.array(*[F.lit(w) for w in NEGATIONS])),
    )
    # Words that open many values ("seal", "verdict") say little; the count of values that hold a word weighs it.
    frequency = segments.select("field", F.explode(words).alias("word"), "n").groupBy("field", "word").agg(F.sum("n").alias("df"))
    total = segments.groupBy("field").agg(F.sum("n").alias("total"))
    idf = frequency.join(total, "field").select("field", "word", F.log(1 + F.col("total") / F.col("df")).alias("w"))

    unit = F.explode(F.concat(F.transform(words, lambda w: F.struct(F.lit("word").alias("kind"), w.alias("token"))), F.transform(leads, lambda s: F.struct(F.lit("whole").alias("kind"), s["token"].alias("token")))))
    tokens = segments.select("field", "cut", unit.alias("u")).select("field", "u.kind", "u.token", "cut").distinct()
    vocabulary = phrases.select("field", F.explode(F.concat(F.transform(F.split("phrase", " "), lambda w: F.struct(F.lit("word").alias("kind"), w.alias("entry"))), F.array(F.struct(F.lit("whole").alias("kind"), F.replace("phrase", F.lit(" "), F.lit("")).alias("entry"))))).alias("u")).select("field", "u.kind", "u.entry").distinct()
    left = tokens.select("field", "kind", "token", "cut", F.explode(_trigrams(F.col("token"))).alias("gram"))
    right = vocabulary.select("field", "kind", "entry", F.explode(_trigrams(F.col("entry"))).alias("gram"))
    pairs = left.join(right, ["field", "kind", "gram"]).select("field", "kind", "token", "cut", "entry").distinct()
    repairs = materialise(pairs.withColumn("sim", _similarity("token", "entry", "cut")).filter("sim > 0"), "repairs")

    # Whole values against whole entries.
    whole = (
        segments.select("field", "value", "part", "cut", F.inline(leads))
        .join(repairs.filter("kind = 'whole'"), ["field", "token", "cut"])
        .join(phrases.withColumn("entry", F.replace("phrase", F.lit(" "), F.lit(""))), ["field", "entry"])
        .select("field", "value", "part", "label_id", (F.lit(1.0) + F.col("sim") - 0.1 * F.col("lead")).alias("score"))
    )
    # Soft TF-IDF: an entry's words each take their most similar corrected word of the value.
    one_word = segments.select("field", "value", "part", "cut", F.explode(words).alias("token")).join(idf.withColumnRenamed("word", "token"), ["field", "token"])
    norms = one_word.groupBy("field", "value", "part").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    entry_words = phrases.select("field", "label_id", "phrase", F.explode(F.array_distinct(F.split("phrase", " "))).alias("entry"))
    weights = idf.withColumnRenamed("word", "entry").withColumnRenamed("w", "we")
    rare = F.log(1 + F.col("total"))
    entry_words = entry_words.join(weights, ["field", "entry"], "left").join(total, "field").withColumn("we", F.coalesce("we", rare)).drop("total")
    entry_norm = entry_words.groupBy("field", "label_id", "phrase").agg(F.sqrt(F.sum(F.col("we") * F.col("we"))).alias("entry_norm"))
    hits = (
        one_word.join(repairs.filter("kind = 'word'").drop("kind"), ["field", "token", "cut"])
        .join(entry_words, ["field", "entry"])
        .groupBy("field", "value", "part", "label_id", "phrase", "entry")
        .agg(F.max(F.col("sim") * F.least("w", "we") * F.col("we")).alias("dot"))
        .groupBy("field", "value", "part", "label_id", "phrase")
        .agg(F.sum("dot").alias("dot"))
    )
    soft = (
        hits.join(entry_norm, ["field", "label_id", "phrase"])
        .join(norms, ["field", "value", "part"])
        .select("field", "value", "part", "label_id", F.least(F.lit(1.0), F.col("dot") / (F.col("norm") * F.col("entry_norm"))).alias("score"))
        .filter(F.col("score") >= MIN_SCORE)
    )
    ranked = whole.unionByName(soft).groupBy("field", "value").agg(
        F.min(F.struct("part", (-F.round("score", 9)).alias("minus"), "label_id")).alias("best")
    )
    return values.select("field", "value").join(ranked, ["field", "value"], "left").select(
        "field", "value", F.coalesce("best.label_id", F.lit(0)).cast("long").alias("label_id"), (-F.col("best.minus")).alias("score")
    )


def map_fields(df: DataFrame, key: str, fields: list[str], reference: DataFrame) -> DataFrame:
    """``key, field, value, label_id`` for each value that isn't exactly a label of its field.

    Null, blank, ``-``, ``n/a`` and ``null`` are no values; 0 stands for no entry.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("value")) for f in fields])
    long = df.select(F.col(f"`{key}`").alias("key"), F.explode(pairs).alias("p")).select("key", "p.field", "p.value")
    long = long.filter(~F.lower(F.trim("value")).isin("", "-", "n/a", "null"))
    # Exact labels go before anything is shuffled: the commonest values are among them.
    labels = reference.select("field", F.col("label").alias("value")).distinct()
    long = long.join(labels, ["field", "value"], "left_anti")
    values = long.groupBy("field", "value").agg(F.count("*").alias("n"))
    answers = materialise(match_values(materialise(values, "values"), reference), "answers")
    return long.join(answers, ["field", "value"]).select("key", "field", "value", "label_id")


def found(items: DataFrame, labels: DataFrame) -> DataFrame:
    """``arrival, field, label_id`` of every verdict and rating that isn't exactly a label."""
    return map_fields(items, "arrival", ["verdict", "rating"], labels).select(F.col("key").alias("arrival"), "field", "label_id")


def unaccented(text: str) -> str:
    """The text in lower case without accents; for tests."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
