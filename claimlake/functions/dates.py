"""Publication dates as ingest and analysis know them; ``operators.timestamps`` reads all other notations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.functions.text import analysis_text, squeeze
from claimlake.operators.timestamps import MONTHS


def published_iso(value: str | None) -> str | None:
    """ISO 8601, a bare date or RFC 822 as ISO 8601 in UTC; naive values are UTC; anything else is null."""
    text = analysis_text(value)
    if not text:
        return None
    moment = None
    for parse in (lambda t: dt.datetime.fromisoformat(t.replace("Z", "+00:00")), lambda t: dt.datetime.strptime(t, "%Y-%m-%d"), parsedate_to_datetime):
        try:
            moment = parse(text)
            break
        except (ValueError, TypeError, IndexError):
            continue
    if moment is None:
        return None
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.UTC)
    try:
        return moment.astimezone(dt.UTC).isoformat()
    except OverflowError:  # year 1 or 9999
        return None


@F.pandas_udf(T.StringType())
def normalize_published_at(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for values in batches:
        yield pd.Series([published_iso(v) for v in values], dtype=object)


def portuguese_date(value: Column) -> Column:
    """``4 de março de 2026 às 10:05`` as ``2026-03-04T10:05:00``; what isn't one comes back squeezed."""
    text = squeeze(value)
    rx = r"(?iU)^(\d{1,2}) de (\w+) de (\d{4})(?: [àa]s? (\d{1,2}:\d{2}))?"
    names = {w: f"{n:02d}" for n, words in MONTHS.items() for w in words.split()[:1]} | {"marco": "03"}
    month = F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.lower(F.regexp_extract(text, rx, 2)))
    clock = F.coalesce(F.nullif(F.regexp_extract(text, rx, 4), F.lit("")), F.lit("00:00"))
    iso = F.concat(F.regexp_extract(text, rx, 3), F.lit("-"), month, F.lit("-"), F.lpad(F.regexp_extract(text, rx, 1), 2, "0"), F.lit("T"), clock, F.lit(":00"))
    return F.when(text.rlike(rx) & month.isNotNull(), iso).otherwise(text)
