"""Scalar text functions.  Three cleanings exist side by side; they aren't the same and aren't merged."""

from __future__ import annotations

import contextlib
import html
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space as Python's str methods see it, in Java's notation.
WS = r"[\s\x1c-\x1f\x85   -     　]"
# Texts that stand for no value in analysis, and characters that betray UTF-8 read as Latin-1.
PLACEHOLDERS = ("", "-", "none", "null", "nan", "n/a")
GARBLE_MARKS = ("Ã", "Â", "â", "\ufffd")
# What stands for a missing date at ingest.
DATE_PLACEHOLDERS = ("-", "–", "—")

_SPACE = re.compile(r"\s+")


def squeeze(value: Column) -> Column:
    """White space runs as one space, trimmed; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(value, f"{WS}+", " ")), F.lit(""))


def strip(value: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(value, f"^{WS}+|{WS}+$", "")


def light_repair(text: str) -> str:
    """UTF-8 that was read as Latin-1, if turning it back leaves fewer garble marks."""
    readings = [text]
    if not text.isascii():
        with contextlib.suppress(UnicodeError):
            readings.append(str(text.encode("latin-1"), "utf-8"))
    # The text itself comes first, so an equal reading doesn't replace it.
    return min(readings, key=lambda t: sum(map(t.count, GARBLE_MARKS)))


def stored_text(text: str | None) -> str | None:
    """Ingest cleaning: entities, light repair, NFKC, white space."""
    if text is None:
        return None
    text = unicodedata.normalize("NFKC", light_repair(html.unescape(text)))
    return _SPACE.sub(" ", text).strip() or None


def analysis_text(text: str | None) -> str | None:
    """Ingest cleaning, and placeholders as null."""
    text = stored_text(text)
    return None if text is None or text.casefold() in PLACEHOLDERS else text


def analysis_list(values: list[str | None] | None) -> list[str]:
    """Cleaned, without nulls and case-folded repeats; first spelling and order kept."""
    kept: dict[str, str] = {}
    for text in map(analysis_text, values if values is not None else ()):
        if text:
            kept.setdefault(text.casefold(), text)
    return list(kept.values())


def stored_list(values: list[str | None] | None) -> list[str] | None:
    """Cleaned at ingest, without nulls, repeats kept."""
    return None if values is None else [t for t in map(stored_text, values) if t]


def label_key(text: str | None) -> str | None:
    """A verdict as a key: lower case without accents, other characters but colons as one underscore."""
    text = analysis_text(text)
    if text is None:
        return None
    plain = "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
    return re.sub(r"[^a-z0-9:]+", "_", plain.replace("...", " ").replace("/", " ")).strip("_")


def _vectorised(function: Callable, kind: T.DataType) -> Callable[[Column], Column]:
    """A function of single values; not an iterator, so that Spark evaluates all such columns of a table in one Python stage."""

    @F.pandas_udf(kind)
    def apply(values: pd.Series) -> pd.Series:
        return pd.Series([function(v) for v in values], dtype=object)

    return apply


clean_stored = _vectorised(stored_text, T.StringType())
clean_analysis = _vectorised(analysis_text, T.StringType())
clean_stored_list = _vectorised(stored_list, T.ArrayType(T.StringType()))
clean_analysis_list = _vectorised(analysis_list, T.ArrayType(T.StringType()))
label_key_of = _vectorised(label_key, T.StringType())
casefold = _vectorised(lambda v: None if v is None else v.casefold(), T.StringType())


def light_repair_native(value: Column) -> Column:
    """``light_repair`` inside Spark: only text of Latin-1 characters is re-encoded, invalid UTF-8 stays as it was."""
    marks = lambda v: F.length(v) - F.length(F.regexp_replace(v, f"[{''.join(GARBLE_MARKS)}]", ""))
    fixed = F.when(value.rlike(r"^[\x00-\xff]*$"), F.try_validate_utf8(F.encode(value, "ISO-8859-1").cast("string")))
    return F.when(fixed.isNotNull() & (marks(fixed) < marks(value)), fixed).otherwise(value)


def first_text(*values: Column) -> Column:
    """The first of several values that isn't blank, squeezed; arrays are searched in order."""
    return F.coalesce(*[squeeze(v) for v in values])


def unique_list(values: Column) -> Column:
    """Squeezed, without blanks and repeats (case counts), first-seen order."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), squeeze), lambda x: x.isNotNull()))


def split_keywords(values: Column) -> Column:
    """Comma-separated keywords of all entries, unique."""
    return unique_list(F.flatten(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.split(x, ","))))


def before_colon(value: Column) -> Column:
    text = squeeze(value)
    return F.when(F.contains(text, F.lit(":")), squeeze(F.substring_index(text, ":", 1)))


def after_colon(value: Column) -> Column:
    text = squeeze(value)
    return F.when(F.contains(text, F.lit(":")), squeeze(F.regexp_extract(text, r"(?s)^[^:]*:(.*)$", 1)))


def is_filled(value: Column, kind: str = "string") -> Column:
    """Not null, not blank, not an empty list."""
    if kind.startswith("array"):
        return F.coalesce(F.size(value) > 0, F.lit(False))
    return F.coalesce(F.length(strip(value)) > 0, F.lit(False))


def is_probable_url(value: Column) -> Column:
    return F.coalesce(value.rlike(r"(?i)^https?://[^/?#]+"), F.lit(False))


def is_date_placeholder(value: Column) -> Column:
    return F.coalesce(squeeze(value).isin(*DATE_PLACEHOLDERS), F.lit(False))


def claim_without_tag(title: Column, summary: Column) -> Column:
    """A title without its trailing site tag; the summary where there is no title."""
    return F.when(squeeze(title).isNull(), summary).otherwise(F.trim(F.regexp_replace(title, r"(?iU)\s+#boato\b", "")))


def claim_without_verdict_suffix(title: Column) -> Column:
    return squeeze(F.regexp_replace(title, r"(?iU)\s+(Verdadeiro|Falso|Errado|Impreciso|Verdade,?\s*mas)$", ""))


def claim_without_verdict_prefix(title: Column, verdict: Column) -> Column:
    """A title without ``É #VERDICT que``, for the verdict that was found."""
    found = F.upper(F.regexp_extract(title, r"(?iU)^\s*(?:E|É)\s+#?(FAKE|FATO|VERDADE)\b", 1))
    bare = F.regexp_replace(title, r"(?iU)^\s*(?:E|É)\s+#?(?:FAKE|FATO|VERDADE)\b\s*(?:que\b)?\s*[:\-–—]?\s*", "")
    return squeeze(F.when((found != "") & (found == verdict), bare).otherwise(title))
