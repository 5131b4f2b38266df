"""Core queries by name: ``(spark, directory) -> DataFrame``, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.functions import dates, jsonld, labels, text, urls
from claimlake.operators import discovery, extraction, ingest, multivalue, processing, profiles, quality, runs, timestamps
from claimlake.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, with the SQL that gives the same rows."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


class _Sql(str):
    """SQL with numbered gaps; its own braces stay as they are."""

    def format(self, *parts: str) -> str:  # type: ignore[override]
        out = str(self)
        for i, part in enumerate(parts):
            out = out.replace(f"{{{i}}}", part)
        return out


# Pieces of SQL: white space as Python sees it, a squeezed and a stripped text, a filled field.
_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_SQUEEZE = _Sql(f"nullif(trim(regexp_replace({{0}}, '{_WS}+', ' ', 'g')), '')")
_STRIP = _Sql(f"regexp_replace({{0}}, '^{_WS}+|{_WS}+$', '', 'g')")
_FILLED = _Sql(f"coalesce(length({_STRIP}) > 0, false)")
_LISTS = ("topics", "tags", "entities")


def _filled(field: str) -> str:
    return f"coalesce(len({field}) > 0, false)" if field in _LISTS else _FILLED.format(field)


@query(
    "SELECT spider, count(*) AS items, "
    + ", ".join(f"count(*) FILTER (WHERE {_filled(f)}) AS filled_{f}" for f in quality.PROFILED)
    + ", "
    + ", ".join(f"coalesce(avg(length({_STRIP.format(f)})) FILTER (WHERE {_filled(f)}), 0.0) AS avg_{f}_length" for f in quality.MEASURED)
    + f", count(*) FILTER (WHERE NOT {_filled('verdict')}) AS null_verdict, count(*) FILTER (WHERE {_filled('verdict')}) / count(*) AS verdict_fill_rate"
    + " FROM items GROUP BY spider"
)
def quality_profile(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality_profile(table(spark, d, "items"))


@query(
    " UNION ALL ".join(
        f"SELECT spider, '{f}' AS field, count(*) FILTER (WHERE {_filled(f)}) / count(*) AS fill_rate FROM items GROUP BY spider HAVING count(*) FILTER (WHERE {_filled(f)}) > 0"
        for f in quality.PROFILED
    )
)
def fill_rates(spark: SparkSession, d: str) -> DataFrame:
    return quality.fill_rates(quality.quality_profile(table(spark, d, "items")))


_RUN_SPIDERS = """
WITH entries AS (
  SELECT run_id, started_at AS run_started_at, finished_at AS run_finished_at, unnest(map_entries(spiders)) AS e FROM runs
), run_spiders AS (
  SELECT DISTINCT run_id, e.key AS spider, coalesce(e.value.agency_id, e.key) AS agency_id, coalesce(e.value.agency_name, e.key) AS agency_name,
    coalesce(e.value.started_at, '') AS started_at, coalesce(e.value.finished_at, '') AS finished_at,
    coalesce(e.value.items_seen, 0) AS items_seen, coalesce(e.value.items_stored, 0) AS items_stored,
    coalesce(e.value.items_deduped, 0) AS items_deduped, coalesce(e.value.items_invalid, 0) AS items_invalid, run_started_at, run_finished_at
  FROM entries
)
"""


def _run_spiders(spark: SparkSession, d: str) -> DataFrame:
    return runs.run_spiders(table(spark, d, "runs"))


@query(_RUN_SPIDERS + "SELECT * FROM run_spiders")
def run_spiders(spark: SparkSession, d: str) -> DataFrame:
    return _run_spiders(spark, d)


@query(
    _RUN_SPIDERS
    + """SELECT run_id, spider, agency_id, items_seen, items_stored, items_deduped, items_invalid,
    CASE WHEN items_seen = 0 THEN 0.0 ELSE items_stored / items_seen END AS store_rate, items_stored = 0 AS zero_items FROM run_spiders"""
)
def run_report(spark: SparkSession, d: str) -> DataFrame:
    return runs.run_report(_run_spiders(spark, d))


@query(
    _RUN_SPIDERS
    + """SELECT run_id, CAST(sum(items_seen) AS BIGINT) AS items_seen, CAST(sum(items_stored) AS BIGINT) AS items_stored,
    CAST(sum(items_deduped) AS BIGINT) AS items_deduped, CAST(sum(items_invalid) AS BIGINT) AS items_invalid, min(nullif(started_at, '')) AS started_at,
    max(nullif(finished_at, '')) AS finished_at, count(*) AS spiders, count(*) FILTER (WHERE items_stored = 0) AS zero_spiders FROM run_spiders GROUP BY run_id"""
)
def run_totals(spark: SparkSession, d: str) -> DataFrame:
    return runs.run_totals(_run_spiders(spark, d))


@query(
    _RUN_SPIDERS
    + """SELECT run_id, spider, spider || ': 0 items stored (seen=' || items_seen || ', invalid=' || items_invalid || ')' AS alert
    FROM run_spiders WHERE items_stored = 0"""
)
def run_alerts(spark: SparkSession, d: str) -> DataFrame:
    return runs.alerts(_run_spiders(spark, d))


@query(_RUN_SPIDERS + "SELECT DISTINCT run_id FROM run_spiders ORDER BY run_id DESC LIMIT 5")
def latest_runs(spark: SparkSession, d: str) -> DataFrame:
    return runs.latest_runs(_run_spiders(spark, d), 5)


@query(_RUN_SPIDERS + "SELECT *, CAST(row_number() OVER (PARTITION BY spider ORDER BY run_id) AS INTEGER) AS run_no FROM run_spiders")
def runs_by_spider(spark: SparkSession, d: str) -> DataFrame:
    return runs.by_spider(_run_spiders(spark, d))


_SELECTED = (
    _RUN_SPIDERS.rstrip()
    + """, picked AS (
  SELECT spider, max(run_id) AS latest_run_id, max(run_id) FILTER (WHERE items_stored > 0) AS latest_valid_run_id, count(*) AS runs FROM run_spiders GROUP BY spider
), named AS (
  SELECT run_id, spider, max(agency_id) AS agency_id, arg_max(agency_name, agency_id || chr(0) || agency_name) AS agency_name FROM run_spiders GROUP BY run_id, spider
), selections AS (
  SELECT spider, latest_run_id, latest_valid_run_id, coalesce(latest_valid_run_id, latest_run_id) AS selected_run_id, named.agency_id, named.agency_name,
    coalesce(latest_valid_run_id < latest_run_id, false) AS fallback_applied,
    CASE WHEN latest_valid_run_id IS NULL THEN 'latest_run_without_valid_items' WHEN latest_valid_run_id < latest_run_id THEN 'fallback_to_latest_valid_run'
      ELSE 'latest_valid_run' END AS selection_reason, runs
  FROM picked JOIN named USING (spider) WHERE named.run_id = coalesce(latest_valid_run_id, latest_run_id)
)
"""
)


@query(_SELECTED + "SELECT * FROM selections")
def select_runs(spark: SparkSession, d: str) -> DataFrame:
    return runs.select_runs(_run_spiders(spark, d))


_CANONICAL = _Sql(r"""
CASE WHEN {0} IS NULL OR {0} = '' THEN {0} ELSE
  lower(CASE WHEN regexp_extract({0}, '^([a-zA-Z][a-zA-Z0-9+.\-]*):', 1) = '' THEN 'https' ELSE regexp_extract({0}, '^([a-zA-Z][a-zA-Z0-9+.\-]*):', 1) END)
  || ':' || CASE WHEN regexp_extract({0}, '^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)', 1) = '' THEN '' ELSE '//' || lower(regexp_extract({0}, '^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)', 1)) END
  || CASE WHEN regexp_extract({0}, '^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1) IN ('', '/') THEN '/'
       ELSE regexp_replace(regexp_extract({0}, '^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '/$', '') END
  || coalesce('?' || nullif(array_to_string(list_transform(list_sort(list_filter(list_transform(
       list_filter(string_split(regexp_extract({0}, '^[^?#]*\?([^#]*)', 1), '&'), lambda s: s <> ''),
       lambda s: {'k': url_decode(replace(string_split(s, '=')[1], '+', ' ')), 'v': url_decode(replace(regexp_extract(s, '^[^=]*=(.*)$', 1), '+', ' '))}),
       lambda p: NOT (lower(p.k) LIKE 'utm\_%' ESCAPE '\' OR lower(p.k) IN ('fbclid', 'gclid', 'igshid', 'mc_cid', 'mc_eid', 'ref')))),
       lambda p: replace(url_encode(p.k), '%20', '+') || '=' || replace(url_encode(p.v), '%20', '+')), '&'), ''), '') END
""")


@query(f"SELECT arrival, {_CANONICAL.format('source_url')} AS url FROM items")
def canonical_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "items").select("arrival", urls.canonicalize_url(F.col("source_url")).alias("url"))


@query("SELECT arrival, sha256(agency_id || '|' || canonical_url) AS made_id, sha256(agency_id || '|' || canonical_url) = item_id AS is_own FROM items")
def item_ids(spark: SparkSession, d: str) -> DataFrame:
    made = urls.make_item_id(F.col("agency_id"), F.col("canonical_url"))
    return table(spark, d, "items").select("arrival", made.alias("made_id"), (made == F.col("item_id")).alias("is_own"))


_DECIDED = f"""
WITH filled AS (
  SELECT *, coalesce(nullif(source_url, ''), nullif(canonical_url, '')) AS src, coalesce(nullif(canonical_url, ''), {_CANONICAL.format("source_url")}) AS canon FROM items
), checked AS (
  SELECT *, NOT ({' AND '.join(_FILLED.format(f) for f in ('item_id', 'agency_id', 'agency_name', 'spider', 'src', 'canon', 'title', 'published_at', 'collected_at', 'run_id'))})
    OR coalesce(regexp_matches(title, '(?i)^https?://[^/?#]+') AND {_CANONICAL.format("title")} IN ({_CANONICAL.format("src")}, {_CANONICAL.format("canon")}), false)
    OR coalesce({_SQUEEZE.format("published_at")} IN ('-', '–', '—'), false) AS bad,
    sha256(agency_id || '|' || canon) AS dedupe_key
  FROM filled
), decided AS (
  SELECT *, CASE WHEN bad THEN 'invalid'
    WHEN dedupe_key IN (SELECT item_id FROM seen) OR row_number() OVER (PARTITION BY bad, CASE WHEN bad THEN CAST(arrival AS VARCHAR) ELSE dedupe_key END ORDER BY arrival, item_id) > 1 THEN 'deduped'
    ELSE 'stored' END AS status
  FROM checked
)
"""


def _decided(spark: SparkSession, d: str) -> DataFrame:
    filled = ingest.default_items(table(spark, d, "items"), collected_at="")
    return ingest.decide(filled, table(spark, d, "seen"))


@query(_DECIDED + "SELECT arrival, dedupe_key, status FROM decided")
def ingest_status(spark: SparkSession, d: str) -> DataFrame:
    return _decided(spark, d).select("arrival", "dedupe_key", "status")


@query(
    _DECIDED
    + """SELECT run_id, spider, count(*) AS items_seen, count(*) FILTER (WHERE status = 'stored') AS items_stored,
    count(*) FILTER (WHERE status = 'deduped') AS items_deduped, count(*) FILTER (WHERE status = 'invalid') AS items_invalid FROM decided GROUP BY run_id, spider"""
)
def ingest_counts(spark: SparkSession, d: str) -> DataFrame:
    return ingest.run_counts(_decided(spark, d))


@query(_DECIDED + "SELECT agency_id, dedupe_key AS item_id, canon AS canonical_url, src AS source_url FROM decided WHERE status = 'stored'")
def new_history(spark: SparkSession, d: str) -> DataFrame:
    return ingest.new_seen(_decided(spark, d)).drop("seen_at")


@query(
    """SELECT item_id, coalesce(arg_min(struct_pack(c := coalesce(canonical_url, ''), s := coalesce(source_url, ''), a := coalesce(seen_at, '')),
      concat_ws(chr(1), coalesce(canonical_url, ''), coalesce(source_url, ''), coalesce(seen_at, ''))).c, '') AS canonical_url,
      arg_min(struct_pack(s := coalesce(source_url, '')), concat_ws(chr(1), coalesce(canonical_url, ''), coalesce(source_url, ''), coalesce(seen_at, ''))).s AS source_url,
      arg_min(struct_pack(a := coalesce(seen_at, '')), concat_ws(chr(1), coalesce(canonical_url, ''), coalesce(source_url, ''), coalesce(seen_at, ''))).a AS seen_at
    FROM seen WHERE item_id <> '' GROUP BY item_id"""
)
def legacy_history(spark: SparkSession, d: str) -> DataFrame:
    """The history as legacy lines, read back; of two lines of one id the first in the order given wins."""
    seen = table(spark, d, "seen")
    order = F.concat_ws("\x01", *[F.coalesce(c, F.lit("")) for c in ("canonical_url", "source_url", "seen_at")])
    lines = seen.select(F.to_json(F.struct("item_id", "canonical_url", "source_url", "seen_at")).alias("value"), order.alias("place"))
    return ingest.migrate_seen(lines, order="place")


_LABEL = _Sql("regexp_replace(regexp_replace(replace(replace(lower(strip_accents({0})), '...', ' '), '/', ' '), '[^a-z0-9:]+', '_', 'g'), '^_+|_+$', '', 'g')")
_RAW_LABEL = _SQUEEZE.format("coalesce(nullif(verdict, ''), rating)")


def _standard_label(label: Column) -> Column:
    key = text.label_key_of(label)
    return labels.standard_label(label, key, label, key)


@query(
    f"""
WITH cleaned AS (SELECT arrival, {_RAW_LABEL} AS raw FROM items), named AS (
  SELECT arrival, CASE WHEN lower(raw) IN ('-', 'none', 'null', 'nan', 'n/a') THEN NULL ELSE raw END AS label FROM cleaned
), keyed AS (SELECT *, {_LABEL.format("label")} AS label_key FROM named)
SELECT arrival, label_key, CASE WHEN label IS NULL THEN 'missing' WHEN regexp_matches(label, '(?i)^https?://|^[0-9]+$') THEN 'other' """
    + " ".join(f"WHEN label_key IN ({', '.join(repr(k) for k in keys.split())}) THEN '{name}'" for name, keys in labels.LABEL_KEYS.items())
    + " WHEN lower(label) LIKE 'enganoso:%' OR lower(label) LIKE 'contextualizando:%' THEN 'misleading' ELSE 'other' END AS standard_label FROM keyed"
)
def label_taxonomy(spark: SparkSession, d: str) -> DataFrame:
    raw = F.coalesce(F.nullif("verdict", F.lit("")), F.col("rating"))
    named = table(spark, d, "items").select("arrival", text.clean_analysis(raw).alias("label"))
    return named.select("arrival", text.label_key_of(F.col("label")).alias("label_key"), _standard_label(F.col("label")).alias("standard_label"))


_B = r"(?:^|[^\p{L}\p{N}_])"
_E = r"(?:$|[^\p{L}\p{N}_])"


def _infer_sql(value: str) -> str:
    """The patterns with explicit Unicode word ends."""
    whens = []
    for pattern, verdict in labels.VERDICT_PATTERNS:
        options = "|".join(f"{_B}{o.removeprefix(chr(92) + 'b').removesuffix(chr(92) + 'b')}{_E}" for o in pattern.split("|"))
        whens.append(f"WHEN regexp_matches({value}, '{options}') THEN '{verdict}'")
    return f"CASE {' '.join(whens)} END"


@query(
    f"""SELECT arrival, coalesce({_infer_sql(f"lower({_SQUEEZE.format('verdict')})")}, {_infer_sql(f"lower({_SQUEEZE.format('title')})")}, {_infer_sql(f"lower({_SQUEEZE.format('summary')})")}) AS verdict FROM items"""
)
def inferred_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "items").select("arrival", labels.infer_verdict(F.col("verdict"), F.col("title"), F.col("summary")).alias("verdict"))


_UNIQUE = _Sql("""
SELECT arrival, string_agg(x, '¦' ORDER BY place) AS {1} FROM (
  SELECT arrival, x, min(place) AS place FROM (SELECT arrival, {2} AS x, place FROM ({0})) WHERE x IS NOT NULL GROUP BY arrival, x
) GROUP BY arrival
""")


@query(_UNIQUE.format("SELECT arrival, unnest(tags) AS raw, generate_subscripts(tags, 1) AS place FROM items", "tags", _SQUEEZE.format("raw")))
def unique_tags(spark: SparkSession, d: str) -> DataFrame:
    tags = text.unique_list(F.col("tags"))
    return table(spark, d, "items").filter(F.size(tags) > 0).select("arrival", F.array_join(tags, "¦").alias("tags"))


@query(
    _UNIQUE.format(
        """SELECT arrival, unnest(string_split(t, ',')) AS raw, place * 1000000 + generate_subscripts(string_split(t, ','), 1) AS place
             FROM (SELECT arrival, unnest(tags) AS t, generate_subscripts(tags, 1) AS place FROM items)""",
        "keywords", _SQUEEZE.format("raw"),
    )
)
def split_keywords(spark: SparkSession, d: str) -> DataFrame:
    found = text.split_keywords(F.col("tags"))
    return table(spark, d, "items").filter(F.size(found) > 0).select("arrival", F.array_join(found, "¦").alias("keywords"))


@query(
    f"""SELECT arrival, CASE WHEN v LIKE '%:%' THEN {_SQUEEZE.format("string_split(v, ':')[1]")} END AS before_colon,
      CASE WHEN v LIKE '%:%' THEN {_SQUEEZE.format("regexp_extract(v, '^[^:]*:(.*)$', 1)")} END AS after_colon FROM (SELECT arrival, {_SQUEEZE.format("verdict")} AS v FROM items)"""
)
def label_parts(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("verdict")
    return table(spark, d, "items").select("arrival", text.before_colon(v).alias("before_colon"), text.after_colon(v).alias("after_colon"))


_MONTH_SQL = _Sql("CASE lower(regexp_extract(v, '{0}', 2)) " + " ".join(
    f"WHEN '{w}' THEN '{n:02d}'" for n, w in enumerate("janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro".split(), 1)
) + " WHEN 'marco' THEN '03' END")
_LONG = r"(?i)^([0-9]{1,2}) de ([\p{L}\p{N}_]+) de ([0-9]{4})(?: [àa]s? ([0-9]{1,2}:[0-9]{2}))?"


@query(
    f"""SELECT arrival, CASE WHEN regexp_matches(v, '{_LONG}') AND m IS NOT NULL THEN regexp_extract(v, '{_LONG}', 3) || '-' || m || '-' || lpad(regexp_extract(v, '{_LONG}', 1), 2, '0') || 'T'
      || CASE WHEN regexp_extract(v, '{_LONG}', 4) = '' THEN '00:00' ELSE regexp_extract(v, '{_LONG}', 4) END || ':00' ELSE v END AS published_at
    FROM (SELECT arrival, v, {_MONTH_SQL.format(_LONG)} AS m FROM (SELECT arrival, {_SQUEEZE.format("published_at")} AS v FROM items))"""
)
def portuguese_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "items").select("arrival", dates.portuguese_date(F.col("published_at")).alias("published_at"))


@query()
def published_iso(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "items").select("arrival", dates.normalize_published_at("published_at").alias("published_at"))


@query(
    "SELECT arrival, "
    + " OR ".join(f"contains(lower(left(coalesce(summary, ''), {extraction.BLOCK_BYTES})), '{m}')" for m in extraction.BLOCK_MARKERS)
    + " AS blocked FROM items"
)
def blocked_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "items").select("arrival", extraction.looks_blocked(F.lit(200), F.col("summary")).alias("blocked"))


def _pages(items: DataFrame, spider: str) -> DataFrame:
    """Items written as pages with JSON-LD, the way an agency publishes them."""
    article = F.struct(
        F.lit("NewsArticle").alias("@type"), F.col("title").alias("headline"), F.col("published_at").alias("datePublished"), F.col("summary").alias("description"), F.col("canonical_url").alias("url"),
        F.col("body").alias("articleBody"), F.struct(F.lit("Person").alias("@type"), F.col("author").alias("name")).alias("author"), F.col("language").alias("inLanguage"),
    )
    review = F.struct(
        F.lit("ClaimReview").alias("@type"), F.col("claim").alias("claimReviewed"), F.col("canonical_url").alias("url"), F.struct(F.col("verdict").alias("alternateName"), F.col("rating").alias("ratingValue")).alias("reviewRating"),
    )
    script = lambda node: F.concat(F.lit('<script type="application/ld+json">'), F.to_json(node), F.lit("</script>"))
    page = F.concat(F.lit("<html><head>"), script(article), script(review), F.lit("</head><body><p>x</p></body></html>"))
    return items.select("arrival", F.lit(spider).alias("spider"), F.col("source_url").alias("url"), F.lit(200).alias("status"), page.alias("body"))


@query(
    f"""SELECT source_url, canonical_url, {_SQUEEZE.format("title")} AS title, {_SQUEEZE.format("published_at")} AS published_at, {_SQUEEZE.format("summary")} AS summary,
      coalesce({_SQUEEZE.format("claim")}, {_SQUEEZE.format("title")}, {_SQUEEZE.format("summary")}) AS claim, {_SQUEEZE.format("body")} AS body, {_SQUEEZE.format("author")} AS author,
      {_SQUEEZE.format("language")} AS language, count(*) AS pages
    FROM (SELECT source_url, {_CANONICAL.format("canonical_url")} AS canonical_url, title, published_at, summary, claim, body, author, language FROM items) GROUP BY ALL"""
)
def extracted_articles(spark: SparkSession, d: str) -> DataFrame:
    made = extraction.extract_articles(_pages(table(spark, d, "items"), "afp_checamos"))
    fields = ["source_url", "canonical_url", "title", "published_at", "summary", "claim", "body", "author", "language"]
    return made.groupBy(*fields).agg(F.count("*").alias("pages"))


@query("SELECT url, count(*) AS n FROM (SELECT unnest([trim(canonical_url), trim(source_url)]) AS url FROM items WHERE canonical_url IS NOT NULL AND source_url IS NOT NULL) GROUP BY url")
def sitemap_links(spark: SparkSession, d: str) -> DataFrame:
    escape = lambda c: F.replace(F.replace(F.replace(F.trim(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    loc = lambda c: F.concat(F.lit("<url><loc>"), escape(F.col(c)), F.lit("</loc></url>"))
    body = F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), loc("canonical_url"), loc("source_url"), F.lit("</urlset>"))
    found = discovery.sitemap_locations(table(spark, d, "items").select(body.alias("body")).filter("body is not null"))
    return found.select(F.explode("locations").alias("url")).groupBy("url").agg(F.count("*").alias("n"))


@query(
    _SELECTED
    + """SELECT spider, count(*) AS records FROM items JOIN selections USING (spider) WHERE items.run_id = selections.selected_run_id GROUP BY ROLLUP (spider)"""
)
def snapshot_counts(spark: SparkSession, d: str) -> DataFrame:
    return processing.snapshot_counts(processing.processed_records(table(spark, d, "items"), runs.select_runs(_run_spiders(spark, d))))


@query(
    _SELECTED
    + f"""SELECT s.spider, s.agency_id, s.agency_name, latest_run_id, latest_valid_run_id, selected_run_id, fallback_applied, selection_reason,
      (SELECT count(*) FROM items i WHERE i.spider = s.spider AND i.run_id = s.selected_run_id) AS record_count,
      '{','.join(profiles.BASE_FLAGS)}' || CASE WHEN fallback_applied THEN ',fallback_to_latest_valid_run' ELSE '' END AS cleaning_flags FROM selections s"""
)
def manifest_entries(spark: SparkSession, d: str) -> DataFrame:
    selections = runs.select_runs(_run_spiders(spark, d))
    records = processing.processed_records(table(spark, d, "items"), selections)
    counts = records.groupBy(F.col("metadata.spider").alias("spider")).agg(F.count("*").alias("records"))
    entries = runs.manifest_entries(selections, counts)
    return entries.drop("diagnostic_run_ids").withColumn("cleaning_flags", F.array_join("cleaning_flags", ","))


@query()
def processed_records(spark: SparkSession, d: str) -> DataFrame:
    return processing.processed_records(table(spark, d, "items"), runs.select_runs(_run_spiders(spark, d)))


@query()
def cleaned_items(spark: SparkSession, d: str) -> DataFrame:
    return ingest.clean_items(table(spark, d, "items"))


@query(
    f"""SELECT arrival, coalesce(regexp_matches(title, '(?i)^https?://[^/?#]+'), false) AS title_is_url, coalesce(regexp_matches(source_url, '(?i)^https?://[^/?#]+'), false) AS source_is_url,
      coalesce({_SQUEEZE.format("published_at")} IN ('-', '–', '—'), false) AS no_date FROM items"""
)
def item_flags(spark: SparkSession, d: str) -> DataFrame:
    url, date = text.is_probable_url, text.is_date_placeholder(F.col("published_at"))
    return table(spark, d, "items").select("arrival", url(F.col("title")).alias("title_is_url"), url(F.col("source_url")).alias("source_is_url"), date.alias("no_date"))


_FIRST = _Sql(f"list_filter(list_transform(coalesce({{0}}, []), lambda x: {_SQUEEZE.format('x')}), lambda x: x IS NOT NULL AND lower(x) NOT IN ('-', 'none', 'null', 'nan', 'n/a'))[1]")


@query(f"SELECT arrival, coalesce({_FIRST.format('topics')}, {_FIRST.format('tags')}) AS category FROM items")
def categories(spark: SparkSession, d: str) -> DataFrame:
    first = lambda c: F.try_element_at(text.clean_analysis_list(F.col(c)), F.lit(1))
    return table(spark, d, "items").select("arrival", F.coalesce(first("topics"), first("tags")).alias("category"))


_NO_VERDICT = f"regexp_replace({_SQUEEZE.format('title')}, '(?i){_WS}+(Verdadeiro|Falso|Errado|Impreciso|Verdade,?{_WS}*mas)$', '')"


@query(f"SELECT arrival, {_SQUEEZE.format(_NO_VERDICT)} AS claim FROM items")
def claims_from_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "items").select("arrival", text.claim_without_verdict_suffix(text.squeeze(F.col("title"))).alias("claim"))


@query("SELECT arrival, CAST(p AS INTEGER) AS pos, t AS type FROM (SELECT arrival, unnest([0, 1]) AS p, unnest(['NewsArticle', 'ClaimReview']) AS t FROM items)")
def jsonld_types(spark: SparkSession, d: str) -> DataFrame:
    nodes = _pages(table(spark, d, "items"), "afp_checamos").select("arrival", F.posexplode(jsonld.jsonld_nodes("body")).alias("pos", "node"))
    return nodes.select("arrival", "pos", F.get_json_object("node", "$['@type']").alias("type"))


@query()
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return timestamps.found(table(spark, d, "items"), table(spark, d, "agencies"))


@query()
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return multivalue.found(table(spark, d, "items"))
