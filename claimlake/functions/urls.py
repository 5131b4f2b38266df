"""Addresses and identifiers."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Query parameters that only track.
TRACKING = ("fbclid", "gclid", "igshid", "mc_cid", "mc_eid", "ref")
TRACKING_PREFIX = "utm_"

_URL = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def canonical(url: str | None) -> str | None:
    """The canonical form, by the standard library; the specification of ``canonicalize_url``."""
    if not url:
        return url
    parts = urlsplit(url)
    path = parts.path or "/"
    if path != "/" and path.endswith("/"):
        path = path[:-1]
    kept = [(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if not (k.lower().startswith(TRACKING_PREFIX) or k.lower() in TRACKING)]
    return urlunsplit((parts.scheme.lower() or "https", parts.netloc.lower(), path, urlencode(sorted(kept)), ""))


def canonicalize_url(url: Column) -> Column:
    """Lower-case scheme and host, one trailing slash off, tracking parameters and fragment dropped, parameters sorted.

    Runs inside Spark.  Null and empty stay as they are; an address without scheme
    gets ``https``.  A parameter with an invalid percent sequence is kept undecoded.
    """
    part = lambda i: F.regexp_extract(url, _URL, i)
    scheme = F.lower(F.when(part(1) == "", F.lit("https")).otherwise(part(1)))
    path = F.when(part(3) == "", F.lit("/")).otherwise(part(3))
    path = F.when((path != "/") & F.endswith(path, F.lit("/")), F.regexp_replace(path, "/$", "")).otherwise(path)
    plain = lambda s: F.coalesce(F.try_url_decode(s), F.replace(s, F.lit("+"), F.lit(" ")))
    pair = lambda s: F.struct(plain(F.substring_index(s, "=", 1)).alias("k"), plain(F.when(F.contains(s, F.lit("=")), F.regexp_extract(s, r"(?s)^[^=]*=(.*)$", 1)).otherwise("")).alias("v"))
    pairs = F.transform(F.filter(F.split(part(4), "&"), lambda s: s != ""), pair)
    kept = F.filter(pairs, lambda p: ~(F.startswith(F.lower(p["k"]), F.lit(TRACKING_PREFIX)) | F.lower(p["k"]).isin(*TRACKING)))
    quote = lambda s: F.replace(F.replace(F.url_encode(s), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
    query = F.array_join(F.transform(F.array_sort(kept), lambda p: F.concat(quote(p["k"]), F.lit("="), quote(p["v"]))), "&")
    host = F.lower(part(2))
    out = F.concat(scheme, F.lit(":"), F.when(host != "", F.concat(F.lit("//"), host)).otherwise(F.lit("")), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(url.isNull() | (url == ""), url).otherwise(out)


@F.pandas_udf(T.StringType())
def join_url(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """A link resolved against the page it stands on; null if there is no link."""
    for bases, links in batches:
        yield pd.Series([urljoin(b or "", u) if u else None for b, u in zip(bases, links, strict=True)], dtype=object)


def make_item_id(agency_id: Column, canonical_url: Column) -> Column:
    """SHA-256 of agency and canonical address, joined by a bar."""
    return F.sha2(F.concat(agency_id, F.lit("|"), canonical_url), 256)


def utc_now_iso() -> str:
    return dt.datetime.now(dt.UTC).replace(microsecond=0).isoformat()


def generate_run_id() -> str:
    """Sortable by time, with eight random hexadecimal digits."""
    return f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"


def default_snapshot_id(prefix: str = "processed") -> str:
    return f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%SZ}-{prefix}"
