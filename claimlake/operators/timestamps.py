"""Timestamps written in many notations: one UTC moment each, or none.

Method: expectation-maximisation over a mixture of formats per source.  Every
value is parsed under each format it fits (inside Spark's own expressions).  The
set of parses, as ``format:year`` pairs, is the value's *signature*; a source
has as many signatures as it has format and year combinations, however many
rows it holds.  Only the signature counts are shuffled; EM runs on them and
learns, per source, how common each format and each year is.  The posterior
then chooses each value's reading, and a reading without a clear lead is marked.

With ``day_first`` day stands before month unless the year comes first.  Whether a
year of two digits does ("24/12/31") is open, and so is whether a day that doesn't
exist ("31/04/25") is one: there the mixture decides, with day first as its prior.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.session import materialise

# Month names in Portuguese, Spanish and English, long and short.
MONTHS = {
    1: "janeiro jan january enero ene",
    2: "fevereiro fev february feb febrero",
    3: "março marco mar march marzo",
    4: "abril abr april apr",
    5: "maio mai may mayo",
    6: "junho jun june junio",
    7: "julho jul july julio",
    8: "agosto ago august aug",
    9: "setembro set september sep sept septiembre",
    10: "outubro out october oct octubre",
    11: "novembro nov november noviembre",
    12: "dezembro dez december dec diciembre dic",
}

# Zone abbreviations, in minutes east of UTC.
ZONE_MINUTES = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 60, "cet": 60, "cest": 120, "bst": 60,
    "wat": 60, "cat": 120, "azot": -60, "azost": 0, "cvt": -60, "brt": -180, "brst": -120, "amt": -240,
    "amst": -180, "act": -300, "fnt": -120, "art": -180, "est": -300, "edt": -240, "cst": -360, "cdt": -300,
    "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
}

# Places named in a bracket after the time, by a word of theirs without accents.
ZONE_PLACES = {
    "brasilia": "America/Sao_Paulo", "sao paulo": "America/Sao_Paulo", "lisboa": "Europe/Lisbon",
    "acores": "Atlantic/Azores", "manaus": "America/Manaus", "luanda": "Africa/Luanda",
    "madeira": "Atlantic/Madeira", "fernando de noronha": "America/Noronha", "rio branco": "America/Rio_Branco",
}

_ZONE = r"(Z|[A-Z]{2,5}|(?:UTC|GMT)? ?[+-]\d{1,2}(?::?\d{2})?)"
_CLOCK = r"(\d{1,2})(?::|h)(\d{2})(?:(?::|m)(\d{2})(?:[.,](\d{1,9}))?s?)?"
_AFTER = rf"(?: ?{_ZONE})?(?: ?\(([^()]*)\))?"
_NAME = r"(\p{L}+)\.?"
_DAY = r"(?:\p{L}+(?:-feira)?\.?,? )?"


@dataclass(frozen=True)
class Format:
    """``pattern`` must match the whole value; ``parts`` names its groups in the order
    year, month, day, hour, minute, second, fraction, am/pm, zone, place (``-`` for none)."""

    name: str
    pattern: str
    parts: str


#: ``mdy`` is read only where the caller leaves the order of numbers open.
FORMATS = (
    Format("iso", rf"(\d{{4}})[-/.](\d{{2}})[-/.](\d{{2}})(?:(?:T| |, )?{_CLOCK}{_AFTER})?", "1 2 3 4 5 6 7 - 8 9"),
    Format("compact", rf"(\d{{4}})(\d{{2}})(\d{{2}})T(\d{{2}})(\d{{2}})(?:(\d{{2}})(?:[.,](\d{{1,9}}))?)? ?{_ZONE}?", "1 2 3 4 5 6 7 - 8 -"),
    Format("dmy", rf"(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}})(?:,? (?:às? |as )?{_CLOCK}(?: ?([AP]M))?{_AFTER})?", "3 2 1 4 5 6 7 8 9 10"),
    Format("dmy2", rf"(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{2}})(?:,? (?:às? |as )?{_CLOCK}(?: ?([AP]M))?{_AFTER})?", "3 2 1 4 5 6 7 8 9 10"),
    Format("mdy", rf"(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}})(?:,? (?:às? |as )?{_CLOCK}(?: ?([AP]M))?{_AFTER})?", "3 1 2 4 5 6 7 8 9 10"),
    Format("ymd2", rf"(\d{{2}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?:,? (?:às? |as )?{_CLOCK}(?: ?([AP]M))?{_AFTER})?", "1 2 3 4 5 6 7 8 9 10"),
    Format("day_name", rf"{_DAY}(\d{{1,2}})(?:º|°)?(?: de | |-){_NAME}(?: de |,? |-)(\d{{4}})(?:(?:,? )(?:às? |as |at )?{_CLOCK}(?: ?([AP]M))?{_AFTER})?", "3 2 1 4 5 6 7 8 9 10"),
    Format("name_day", rf"{_DAY}{_NAME} (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})(?:(?:,? )(?:às? |as |at )?{_CLOCK}(?: ?([AP]M))?{_AFTER})?", "3 1 2 4 5 6 7 8 9 10"),
)

#: Bare numbers since 1970-01-01 UTC, by the power of ten that makes microseconds of one unit.
EPOCHS = {"epoch_s": 6, "epoch_ms": 3, "epoch_us": 0, "epoch_ns": -3}

#: A bare number outside these years isn't a moment in that unit.
EPOCH_YEARS = (1971, 2100)

#: With ``day_first``, a source counts as having so many more values that are read so.
DAY_FIRST = {"dmy2": 50.0}

#: A reading needs this share of the posterior, or it is marked as ambiguous.
CLEAR = 0.9


def _without_accents(value: Column) -> Column:
    return F.translate(value, "áàâãäéèêëíìîïóòôõöúùûüç", "aaaaaeeeeiiiiooooouuuuc")


def _map_of(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def _parts(value: Column, fmt: Format) -> Column:
    """The groups of a matching value as an array of strings, null where it doesn't match."""
    rx = rf"(?iuU)^{fmt.pattern}$"
    order = "\x01".join("" if p == "-" else f"${p}" for p in fmt.parts.split())
    return F.when(
        value.rlike(rx), F.split(F.concat(F.lit(fmt.name + "\x01"), F.regexp_replace(value, rx, order)), "\x01")
    )


def _moment(parts: Column, home_tz: Column) -> Column:
    """One format's groups as a UTC timestamp; null if there is no such day or hour."""
    at = lambda i: F.nullif(parts[i], F.lit(""))
    number = lambda i: at(i).try_cast("int")
    months = {word: n for n, words in MONTHS.items() for word in words.split()}
    year = number(1)
    year = F.when(F.length(parts[1]) == 2, F.when(year < 70, year + 2000).otherwise(year + 1900)).otherwise(year)
    month = F.coalesce(number(2), F.try_element_at(_map_of(months), F.lower(parts[2])))
    half = F.upper(at(8))
    hour = F.coalesce(number(4), F.lit(0))
    hour = (
        F.when(half.isNull(), hour)
        .when((hour < 1) | (hour > 12), F.lit(None))
        .otherwise(hour % 12 + F.when(half == "PM", 12).otherwise(0))
    )
    micros = F.rpad(F.substring(F.coalesce(parts[7], F.lit("")), 1, 6), 6, "0").try_cast("long")
    wall = F.try_make_timestamp(
        year, month, number(3), hour, F.coalesce(number(5), F.lit(0)), F.coalesce(number(6), F.lit(0)).cast("decimal(16,6)")
    )
    zone = F.lower(F.regexp_replace(F.coalesce(parts[9], F.lit("")), " ", ""))
    offset_rx = r"^(?:utc|gmt)?([+-])(\d{1,2}):?(\d{2})?$"
    sign = F.when(F.regexp_extract(zone, offset_rx, 1) == "-", -1).otherwise(1)
    offset = F.when(
        zone.rlike(offset_rx),
        sign
        * (
            F.regexp_extract(zone, offset_rx, 2).try_cast("int") * 60
            + F.coalesce(F.regexp_extract(zone, offset_rx, 3).try_cast("int"), F.lit(0))
        ),
    ).otherwise(F.try_element_at(_map_of(ZONE_MINUTES), zone))
    place = _without_accents(F.lower(F.coalesce(parts[10], F.lit(""))))
    place_tz = F.coalesce(*[F.when(place.contains(word), F.lit(tz)) for word, tz in ZONE_PLACES.items()])
    utc = (
        F.when(offset.isNotNull(), F.timestamp_micros(F.unix_micros(wall) - offset.cast("long") * F.lit(60_000_000)))
        .when(zone != "", F.lit(None))
        .otherwise(F.to_utc_timestamp(wall, F.coalesce(place_tz, home_tz)))
    )
    return F.timestamp_micros(F.unix_micros(utc) + micros)


def readings(value: Column, home_tz: Column, *, day_first: bool = True) -> Column:
    """All valid readings of a string: ``array<struct<format, utc>>``, empty if there is none.

    Null, blank, placeholder and relative values have none.  With ``day_first``
    numbers are day before month unless the year comes first, so both readings of a
    two-digit year compete; without it the month-first reading competes as well.
    """
    text = F.regexp_replace(F.trim(F.regexp_replace(value, r"[\s\u00a0]+", " ")), r"^(?i)(.*\d)(T)(\d.*)$", "$1T$3")
    formats = [f for f in FORMATS if not (day_first and f.name == "mdy")]
    parsed = F.filter(F.array(*[_parts(text, f) for f in formats]), lambda p: p.isNotNull())
    written = F.transform(parsed, lambda p: F.struct(p[0].alias("format"), _moment(p, home_tz).alias("utc")))
    number = F.when(text.rlike(r"^-?\d{1,19}(\.\d{1,8})?$"), text.try_cast("decimal(27,8)"))
    low, high = ((y - 1970) * 31_556_952_000_000 for y in EPOCH_YEARS)
    counted = F.array(
        *[
            F.struct(F.lit(name).alias("format"), F.when((m >= low) & (m < high), F.timestamp_micros(m.try_cast("long"))).alias("utc"))
            for name, power in EPOCHS.items()
            for m in [F.floor(number * F.lit(10.0**power).cast("decimal(10,3)"))]
        ]
    )
    found = F.when(F.regexp_like(text, F.lit(r"^-?\d+(\.\d+)?$")), counted).otherwise(written)
    return F.coalesce(F.filter(found, lambda r: r["utc"].isNotNull()), F.array().cast("array<struct<format:string,utc:timestamp>>"))


def _signature(found: Column) -> Column:
    year = lambda r: F.coalesce(F.year(r["utc"]).cast("string"), F.lit("none"))
    return F.array_join(F.array_sort(F.transform(found, lambda r: F.concat_ws(":", r["format"], year(r)))), ",")


def _or_none(found: Column) -> Column:
    """Adds "no such day" to a lone two-digit year in front that could also be meant as a day."""
    none = F.array(F.struct(F.lit("dmy2").alias("format"), F.lit(None).cast("timestamp").alias("utc")))
    lone = lambda f: (F.size(f) == 1) & (f[0]["format"] == "ymd2") & (F.year(f[0]["utc"]) % 100).between(1, 31)
    # Bound by a lambda, so that the readings are made once.
    return F.transform(F.array(found), lambda f: F.when(lone(f), F.concat(f, none)).otherwise(f))[0]


def fit_mixture(signatures: pd.DataFrame, rounds: int = 50, prior: float = 0.5, more: dict[str, float] | None = None) -> pd.DataFrame:
    """EM of one source from its columns ``signature`` and ``n``; adds ``format`` and ``posterior``.

    Formats and years have Dirichlet priors of ``prior``, so a source of one row is defined too;
    ``more`` adds to the priors of single formats.
    """
    options = [[tuple(o.rsplit(":", 1)) for o in s.split(",")] for s in signatures["signature"]]
    counts = signatures["n"].to_numpy(dtype=float)
    formats, years = {f for o in options for f, _ in o}, {y for o in options for _, y in o}
    weight, share = dict.fromkeys(formats, 1 / len(formats)), dict.fromkeys(years, 1 / len(years))
    for _ in range(rounds):
        new_weight, new_share = {f: prior + (more or {}).get(f, 0.0) for f in formats}, dict.fromkeys(years, prior)
        for found, n in zip(options, counts, strict=True):
            mass = [weight[f] * share[y] for f, y in found]
            total = sum(mass)
            for (f, y), m in zip(found, mass, strict=True):
                new_weight[f] += n * m / total
                new_share[y] += n * m / total
        scale_w, scale_s = sum(new_weight.values()), sum(new_share.values())
        change = max(abs(weight[f] - new_weight[f] / scale_w) for f in formats)
        weight = {f: w / scale_w for f, w in new_weight.items()}
        share = {y: s / scale_s for y, s in new_share.items()}
        if change < 1e-9:
            break
    rows = []
    for signature, found in zip(signatures["signature"], options, strict=True):
        mass = [(weight[f] * share[y], f) for f, y in found]
        total = math.fsum(m for m, _ in mass)
        best = max(mass, key=lambda x: (x[0], x[1]))
        rows.append((signature, best[1], best[0] / total))
    return pd.DataFrame(rows, columns=["signature", "format", "posterior"])


def normalise_timestamps(
    df: DataFrame, *, value: str, source: list[str], home_tz: str, day_first: bool = True, clear: float = CLEAR
) -> DataFrame:
    """Adds ``ts_utc``, ``ts_format``, ``ts_posterior`` and ``ts_ambiguous`` to every row.

    ``source`` are the columns that name the source whose mixture is learned (nulls
    are a source of their own), ``home_tz`` the column with the IANA zone of wall
    times.  Defined cases: a value that names no moment has nulls and ``false``; a
    wall time that occurs twice is the earlier moment and a skipped one keeps the
    offset before the change; without ``home_tz`` a wall time stays unresolved;
    existing columns of the new names are replaced; an empty table stays empty.
    """
    added = ["ts_utc", "ts_format", "ts_posterior", "ts_ambiguous"]
    base = df.drop(*[c for c in added if c in df.columns])
    keys = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")).alias(f"_src{i}") for i, c in enumerate(source)]
    names = [f"_src{i}" for i in range(len(source))]
    # The row travels as one struct, so that its columns may have any names.
    row = F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias("_row")
    read = base.select(row, *keys, readings(F.col(f"`{value}`"), F.col(f"`{home_tz}`"), day_first=day_first).alias("_found"))
    if day_first:
        read = read.withColumn("_found", _or_none(F.col("_found")))
    read = read.withColumn("_signature", _signature(F.col("_found")))
    # A value of one reading teaches its source that format; it is counted like the open ones.
    counts = read.filter(F.size("_found") > 0).groupBy(*names, "_signature").agg(F.count("*").alias("n"))
    counted = materialise(counts, "signatures")
    schema = ", ".join([*(f"{n} string" for n in names), "_signature string", "_format string", "_posterior double"])

    def em(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fitted = fit_mixture(rows.rename(columns={"_signature": "signature"})[["signature", "n"]], more=DAY_FIRST if day_first else None)
        out = pd.DataFrame({n: [g] * len(fitted) for n, g in zip(names, group, strict=True)})
        return out.assign(_signature=fitted["signature"], _format=fitted["format"], _posterior=fitted["posterior"])

    open_ = counted.filter(F.contains(F.col("_signature"), F.lit(",")))
    # Sources in which every value has one reading need no EM; for them the posterior is 1.
    fitted = counted.join(open_.select(*names).distinct(), names, "left_semi").groupBy(*names).applyInPandas(em, schema)
    # Written, so that the optimizer knows its size: broadcast below its threshold, else a sort-merge join.
    fitted = materialise(fitted.filter(F.contains(F.col("_signature"), F.lit(","))), "posteriors")
    joined = read.join(fitted, [*names, "_signature"], "left")
    chosen = F.when(F.size("_found") == 1, F.col("_found")[0]).otherwise(
        F.try_element_at(F.filter("_found", lambda r: r["format"] == F.col("_format")), F.lit(1))
    )
    named = chosen["utc"].isNotNull()
    posterior = F.when(named, F.when(F.size("_found") == 1, F.lit(1.0)).otherwise(F.col("_posterior")))
    return joined.select(
        "_row.*",
        chosen["utc"].alias("ts_utc"),
        F.when(named, chosen["format"]).alias("ts_format"),
        posterior.alias("ts_posterior"),
        F.coalesce(posterior < clear, F.lit(False)).alias("ts_ambiguous"),
    )


def moment_text(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS.ffffffZ`` of a UTC timestamp."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


#: What needs no work: already one unambiguous form.
CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\+00:00$"


def item_moments(items: DataFrame, agencies: DataFrame) -> DataFrame:
    """One row for each of ``published_at`` and ``collected_at`` of each item, with its reading."""
    long = items.select(
        "arrival",
        "agency_id",
        F.explode(
            F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in ("published_at", "collected_at")])
        ).alias("_pair"),
    ).select("arrival", "agency_id", "_pair.field", "_pair.value")
    zones = agencies.groupBy("agency_id").agg(F.min("home_tz").alias("home_tz"))
    return normalise_timestamps(
        long.join(zones, "agency_id", "left"), value="value", source=["agency_id", "field"], home_tz="home_tz"
    )


def found(items: DataFrame, agencies: DataFrame) -> DataFrame:
    """``arrival, field, utc`` of the values that name a moment and aren't in the canonical form."""
    rows = item_moments(items, agencies)
    return rows.filter(F.col("ts_utc").isNotNull() & ~F.col("value").rlike(CANONICAL)).select(
        "arrival", "field", moment_text(F.col("ts_utc")).alias("utc")
    )
