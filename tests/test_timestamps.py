import datetime as dt
import random
from zoneinfo import ZoneInfo

import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimlake.operators import timestamps as t


def read(spark, rows, **options):
    df = spark.createDataFrame([(i, v, z, "s") for i, (v, z) in enumerate(rows)], "i int, v string, tz string, src string")
    out = t.normalise_timestamps(df, value="v", source=["src"], home_tz="tz", **options)
    return {r["i"]: r for r in out.withColumn("u", t.moment_text(F.col("ts_utc"))).collect()}


SP, LX = "America/Sao_Paulo", "Europe/Lisbon"


@pytest.mark.parametrize(
    ("value", "tz", "utc"),
    [
        ("2024-05-19T04:44:33+00:00", SP, "2024-05-19T04:44:33.000000Z"), ("2013-09-27T07:11:38.2499030-03:00", SP, "2013-09-27T10:11:38.249903Z"),
        ("16/02/2013 23:27", SP, "2013-02-17T01:27:00.000000Z"), ("08/08/25 01:45", SP, "2025-08-08T04:45:00.000000Z"), ("1754862513", SP, "2025-08-10T21:48:33.000000Z"),
        ("1754636376308", SP, "2025-08-08T06:59:36.308000Z"), ("Jul 25, 2025 4:40 AM GMT-3", SP, "2025-07-25T07:40:00.000000Z"), ("12 PM", SP, None),
        ("Feb 16, 2025 12:33 AM GMT", SP, "2025-02-16T00:33:00.000000Z"), ("Quinta-feira, 25 de Janeiro de 2024, 21h50", LX, "2024-01-25T21:50:00.000000Z"),
        ("16 ago. 2014 04:06", SP, "2014-08-16T07:06:00.000000Z"), ("12.08.2025, 00h15 (horário de Brasília)", "America/Manaus", "2025-08-12T03:15:00.000000Z"),
        ("2013-01-06 01:22 BRST", SP, "2013-01-06T03:22:00.000000Z"), ("20160922T064951Z", SP, "2016-09-22T06:49:51.000000Z"), ("30 de fevereiro de 2022", SP, None),
        ("2023-13-05", SP, None), ("há 3 dias", SP, None), ("", SP, None), (None, SP, None), ("2024-01-01 25:00", SP, None), ("5 de março de 2023", LX, "2023-03-05T00:00:00.000000Z"),
        ("2024-05-01 10:00", None, None), ("2024-05-01 10:00 ZZZZ", SP, None), ("99999999999999999999999", SP, None), ("29/07/2025 às 04h22", LX, "2025-07-29T03:22:00.000000Z"),
    ],
)
def test_single_values(spark, value, tz, utc):
    assert read(spark, [(value, tz)])[0]["u"] == utc


def test_wall_times_against_the_zone_database(spark):
    """Around every clock change: an hour twice is the earlier moment, a skipped one keeps the offset before."""
    random.seed(7)
    rows = []
    for zone in (SP, LX, "America/Manaus", "Atlantic/Azores"):
        for day in ("2017-10-15", "2018-02-18", "2018-11-04", "2024-03-31", "2024-10-27", "2019-02-17", "2013-02-17"):
            rows += [(f"{day} {h:02d}:{random.randrange(60):02d}:00", zone) for h in (0, 1, 2, 3, 23)]
    got = read(spark, rows)
    for i, (v, zone) in enumerate(rows):
        wall = dt.datetime.fromisoformat(v).replace(tzinfo=ZoneInfo(zone), fold=0)
        assert got[i]["u"] == wall.astimezone(dt.UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ"), (v, zone)


def test_mixture_decides_and_marks_ambiguity(spark):
    month_first = [(f"{m}/{d}/2024 10:00", "UTC") for m in range(1, 13) for d in (14, 20, 27)] + [("03/04/2024 10:00", "UTC")]
    got = read(spark, month_first, day_first=False)
    assert got[len(month_first) - 1]["u"] == "2024-03-04T10:00:00.000000Z" and not got[len(month_first) - 1]["ts_ambiguous"]
    alone = read(spark, [("03/04/2024 10:00", "UTC")], day_first=False)[0]
    assert alone["ts_ambiguous"] and alone["ts_posterior"] == pytest.approx(0.5)


def test_mixture_equals_brute_force():
    sig = pd.DataFrame({"signature": ["dmy:2024", "mdy:2024", "dmy:2024,mdy:2024"], "n": [30, 10, 5]})
    fitted = t.fit_mixture(sig).set_index("signature")
    w = {"dmy": 0.5, "mdy": 0.5}
    for _ in range(200):
        share = w["dmy"] / (w["dmy"] + w["mdy"])
        new = {"dmy": 30 + 5 * share + 0.5, "mdy": 10 + 5 * (1 - share) + 0.5}
        w = {k: v / sum(new.values()) for k, v in new.items()}
    assert fitted.loc["dmy:2024,mdy:2024", "posterior"] == pytest.approx(w["dmy"], abs=1e-6)


def test_tables_of_any_shape(spark):
    empty = spark.createDataFrame([], "v string, tz string, src string")
    assert t.normalise_timestamps(empty, value="v", source=["src"], home_tz="tz").count() == 0
    clash = spark.createDataFrame([("2024-01-01", "UTC", None, "x", "y")] * 2, "v string, tz string, src string, _found string, ts_utc string")
    out = t.normalise_timestamps(clash, value="v", source=["src"], home_tz="tz")
    assert out.columns.count("ts_utc") == 1 and out.count() == 2 and out.first()["_found"] == "x"


def test_found(spark):
    items = spark.createDataFrame(
        [(1, "a", "2024-05-19T04:44:33+00:00", "2024-05-19 04:44"), (2, "a", "ontem", None), (3, "zz", "2024-05-19T04:44:33Z", "2024-05-19 10:00")],
        "arrival long, agency_id string, published_at string, collected_at string",
    )
    agencies = spark.createDataFrame([("a", SP)], "agency_id string, home_tz string")
    got = {(r["arrival"], r["field"]): r["utc"] for r in t.found(items, agencies).collect()}
    assert got == {(1, "collected_at"): "2024-05-19T07:44:00.000000Z", (3, "published_at"): "2024-05-19T04:44:33.000000Z"}


def test_found_learns_where_a_two_digit_year_stands(spark):
    """Day stands before month unless the year comes first: for two digits the source's other values decide."""
    first = [f"{y}/{m:02d}/{d:02d} 10:00" for y in (23, 24) for m in range(1, 13) for d in (2, 11, 19, 28)]
    known = [f"{y}-{m:02d}-20T10:00:00Z" for y in (2023, 2024) for m in range(1, 13)]
    probes = ["24/03/05 10:00", "31/04/24 10:00", "99/03/04 10:00"]
    texts = {"y": [*first, *known, *probes], "d": ["/".join(v[:8].split("/")[::-1]) + v[8:] for v in first] + known + probes, "one": probes}
    rows = [(a, v) for a, vs in texts.items() for v in vs]
    items = spark.createDataFrame([(i, a, v, None) for i, (a, v) in enumerate(rows)], "arrival long, agency_id string, published_at string, collected_at string")
    agencies = spark.createDataFrame([(a, "UTC") for a in texts], "agency_id string, home_tz string")
    got = {r["arrival"]: r["utc"][:10] for r in t.found(items, agencies).collect()}
    at = {(a, v): got.get(i) for i, (a, v) in enumerate(rows)}
    assert all(at["y", v] == "20" + v[:8].replace("/", "-") for v in first)
    assert all(at["d", v] == f"20{v[6:8]}-{v[3:5]}-{v[:2]}" for v in texts["d"][: len(first)])
    assert [at["y", v] for v in probes] == ["2024-03-05", "2031-04-24", "1999-03-04"]
    assert [at[a, v] for a in ("d", "one") for v in probes] == ["2005-03-24", None, "1999-03-04"] * 2
