"""How well items are filled, per spider."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake import schema
from claimlake.functions.text import is_filled, strip

#: Fields that are profiled, and those of which the mean length is taken.
PROFILED = (*schema.OPTIONAL_TEXT, *schema.LISTS)
MEASURED = ("summary", "claim", "body")


def quality_profile(items: DataFrame) -> DataFrame:
    """Per spider: items, how many have each optional field filled, verdicts filled and null, mean lengths of filled texts.

    Ratios aren't rounded.  A null spider is a group of its own; where the table has
    no such column all rows are ``unknown``.  Lengths are characters without outer
    white space; 0.0 where none is filled.
    """
    kinds = dict(items.dtypes)
    rows = items if "spider" in kinds else items.withColumn("spider", F.lit("unknown"))
    filled = {f: is_filled(F.col(f), kinds[f]) for f in PROFILED if f in kinds}
    counts = [F.count_if(c).alias(f"filled_{f}") for f, c in filled.items()]
    means = [F.coalesce(F.avg(F.when(filled[f], F.length(strip(F.col(f))))), F.lit(0.0)).alias(f"avg_{f}_length") for f in MEASURED if f in filled]
    out = rows.groupBy("spider").agg(F.count("*").alias("items"), *counts, *means)
    if "filled_verdict" not in out.columns:
        out = out.withColumn("filled_verdict", F.lit(0).cast("long"))
    return out.withColumn("null_verdict", F.col("items") - F.col("filled_verdict")).withColumn("verdict_fill_rate", F.col("filled_verdict") / F.col("items"))


def fill_rates(profile: DataFrame) -> DataFrame:
    """``spider, field, fill_rate`` of the optional fields that any item of the spider has."""
    fields = [c.removeprefix("filled_") for c in profile.columns if c.startswith("filled_")]
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), (F.col(f"filled_{f}") / F.col("items")).alias("fill_rate")) for f in sorted(fields)])
    return profile.select("spider", F.inline(F.filter(pairs, lambda p: p["fill_rate"] > 0)))


def format_quality(profile: DataFrame) -> str:
    """Two fixed-width tables for people; rounding is Python's.  One row per spider comes to the driver."""
    rows = sorted(profile.collect(), key=lambda r: str(r["spider"]))
    if not rows:
        return "No items to analyze."
    measured = [f for f in MEASURED if f"avg_{f}_length" in profile.columns]
    head = f"{'spider':<24}{'items':>8}{'verdict':>10}" + "".join(f"{f:>10}" for f in measured)
    lines = [head, "-" * len(head)]
    for r in rows:
        means = "".join(f"{round(r[f'avg_{f}_length'], 1):>10}" for f in measured)
        lines.append(f"{r['spider']!s:<24}{r['items']:>8}{round(r['verdict_fill_rate'], 4):>10}{means}")
    fields = sorted(c.removeprefix("filled_") for c in profile.columns if c.startswith("filled_"))
    head = f"{'field':<16}" + "".join(f"{r['spider']!s:>22}" for r in rows)
    lines += ["", head, "-" * len(head)]
    lines += [f"{f:<16}" + "".join(f"{round(r[f'filled_{f}'] / r['items'], 4):>22}" for r in rows) for f in fields]
    return "\n".join(lines)
