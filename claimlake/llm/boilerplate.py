"""Lines that belong to a site and not to its articles: find them per source, and remove them.

Method: PrefixSpan over line-identifier sequences.  Every document is the
sequence of its lines' identifiers (hashes of the normalised lines).  Level 1
counts, per source, in how many distinct documents a line stands; only frequent
lines stay in the sequences, so the projected databases are a small part of the
text.  Each further level extends every frequent prefix by one line found after
its first occurrence, counted by shuffle again, until a level is empty.
Occurrences of frequent sequences of every length, single lines included, are deleted.
For that, lines that never stand apart count as one step of the longer sequences
(``_followers``): a footer of thirty lines would else be a thousand million sequences.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.session import discard, materialise

#: A line is repeated if it stands in this many distinct documents of the source, and in this share of them.
MIN_DOCUMENTS, MIN_SHARE = 5, 0.04


def normalise_line(line: Column) -> Column:
    """Lower case, digit runs as ``0``, other runs of non-alphanumerics as one space, trimmed."""
    text = F.regexp_replace(F.lower(line), r"\p{Nd}+", "0")
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))


def _document(name: str) -> Column:
    """A document's identifier; null for a row without one, which supports no line but loses those that are repeated."""
    return F.when(F.col(f"`{name}`").isNotNull(), F.xxhash64(F.col(f"`{name}`"))).alias("doc")


def _lines(df: DataFrame, source: str, document: str, text: str, extra: dict[str, str]) -> DataFrame:
    """One row per non-empty line: ``src, doc, line_no, line`` (a 128-bit identifier of it)."""
    rows = df.select(
        F.col(f"`{source}`").alias("src"),
        _document(document),
        *[F.col(f"`{c}`").alias(a) for a, c in extra.items()],
        # Rows of one document are versions of it: sequences lie within a row, support counts documents.
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{text}`").alias("text"),
    )
    split = rows.select("src", "doc", "row", *extra, F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    norm = split.withColumn("norm", normalise_line(F.col("raw"))).filter("norm <> ''")
    # Two hashes of different texts, so that a clash of one of them joins nothing.
    line = F.struct(F.xxhash64("norm").alias("a"), F.hash("norm", F.length("norm")).alias("b"))
    return norm.select("src", "doc", "row", *extra, (F.col("line_no") + 1).cast("long").alias("line_no"), line.alias("line"))


def _support(df: DataFrame, source: str, document: str, min_documents: int, min_share: float) -> DataFrame:
    """``src, need``: the distinct documents a sequence needs; one row per source."""
    total = df.select(F.col(f"`{source}`").alias("src"), _document(document)).filter("doc is not null").distinct()
    share = F.ceil(F.round(F.count("*") * F.lit(min_share), 6))
    return total.groupBy("src").agg(F.greatest(F.lit(min_documents), share).cast("long").alias("need"))


def _followers(kept: DataFrame) -> DataFrame:
    """``_s, _l``: lines that always stand right behind the same line, which is always followed by them; others in between are left out.

    Such a line stands in the documents of the line before it, so any sequence through it has the
    support of one through the first of its block.
    """
    before = F.lag("line").over(Window.partitionBy("src", "row").orderBy("line_no"))
    pairs = materialise(kept.select("src", before.alias("before"), "line").groupBy("src", "before", "line").agg(F.count("*").alias("n")), "pairs")
    total = pairs.groupBy("src", "line").agg(F.sum("n").alias("all"))
    ahead, behind = (total.select(F.col("src").alias(f"_s{i}"), F.col("line").alias(f"_l{i}"), F.col("all").alias(f"_n{i}")) for i in (1, 2))
    both = pairs.join(ahead, F.col("src").eqNullSafe(F.col("_s1")) & (F.col("before") == F.col("_l1")) & (F.col("n") == F.col("_n1")))
    both = both.join(behind, F.col("src").eqNullSafe(F.col("_s2")) & (F.col("line") == F.col("_l2")) & (F.col("n") == F.col("_n2")))
    out = materialise(both.select(F.col("src").alias("_s"), F.col("line").alias("_l")), "followers")
    discard(pairs)
    return out


def frequent_sequences(
    df: DataFrame,
    source: str,
    document: str,
    text: str,
    *,
    min_documents: int = MIN_DOCUMENTS,
    min_share: float = MIN_SHARE,
    max_length: int | None = None,
    lines: DataFrame | None = None,
    by_block: bool = False,
) -> DataFrame:
    """``src, lines, length, documents``: all frequent line sequences of each source, gaps allowed.

    Documents that share an identifier count once, rows without one not at all; null
    texts count as documents without lines; a null source is a source of its own.
    Without ``max_length`` levels are mined until one is empty.  ``lines`` may hand over
    the table of line identifiers where the caller has written it already.  With ``by_block``
    sequences of two and more name a block of lines that never stand apart by its first line.
    """
    need = materialise(_support(df, source, document, min_documents, min_share), "need")
    if lines is None:
        lines = materialise(_lines(df, source, document, text, {}), "lines")

    def count(candidates: DataFrame, keys: list[str]) -> DataFrame:
        support = candidates.filter("doc is not null").select(*keys, "doc").distinct().groupBy(*keys).agg(F.count("*").alias("documents"))
        kept = support.join(need.withColumnRenamed("src", "_s"), F.col("src").eqNullSafe(F.col("_s")))
        return kept.filter("documents >= need").drop("_s", "need")

    first = materialise(count(lines, ["src", "line"]), "level1")
    out = first.select("src", F.array("line").alias("lines"), F.lit(1).alias("length"), "documents")
    if max_length == 1:
        return out
    frequent = first.select(F.col("src").alias("_s"), F.col("line").alias("_l"))
    kept = lines.join(frequent, F.col("src").eqNullSafe(F.col("_s")) & (F.col("line") == F.col("_l")), "left_semi")
    if by_block:
        inner = _followers(kept)
        kept = kept.join(inner, F.col("src").eqNullSafe(F.col("_s")) & (F.col("line") == F.col("_l")), "left_anti")
    # The database of frequent lines; it alone is extended from here on.  A document is split by its own size only.
    at_all = F.array_sort(F.collect_set("line_no")).alias("places")
    base = materialise(kept.groupBy("src", "doc", "row", "line").agg(at_all), "frequent")
    projected = base.select("src", "doc", "row", F.array("line").alias("lines"), F.col("places")[0].alias("at"))
    for length in itertools.count(2):
        nxt = base.select(F.col("src").alias("_s"), F.col("row").alias("_r"), F.col("line").alias("_l"), F.col("places").alias("_places"))
        if length == 2:
            follow = nxt
        else:
            # Only lines that extend some frequent prefix of this length can extend a longer one.
            ends = level.select(F.col("src").alias("_s2"), F.element_at("lines", -1).alias("_l2")).distinct()  # noqa: F821
            follow = nxt.join(ends, F.col("_s").eqNullSafe(F.col("_s2")) & (F.col("_l") == F.col("_l2")), "left_semi")
        same = F.col("row") == F.col("_r")
        # The earliest place after the prefix leaves the most room for longer sequences.
        grown = (
            projected.join(follow, same & (F.element_at("_places", -1) > F.col("at")))
            .withColumn("_next", F.filter("_places", lambda p: p > F.col("at"))[0])
            .select("src", "doc", "row", F.concat("lines", F.array("_l")).alias("lines"), F.col("_next").alias("at"))
        )
        level = materialise(count(grown, ["src", "lines"]), f"level{length}")
        out = out.unionByName(level.select("src", "lines", F.lit(length).alias("length"), "documents"))
        if length == max_length or not level.head(1):
            discard(base, projected, need, *([inner] if by_block else []))
            return out
        frequent_prefix = level.select(F.col("src").alias("_s"), F.col("lines").alias("_p"))
        shorter, projected = projected, materialise(
            grown.join(frequent_prefix, F.col("src").eqNullSafe(F.col("_s")) & (F.col("lines") == F.col("_p")), "left_semi"),
            f"projected{length}",
        )
        discard(shorter)


def repeated_lines(df: DataFrame, key: str, source: str, document: str, text: str, **options: float) -> DataFrame:
    """``key, line_no``: every occurrence of a line of a frequent sequence; lines are counted from 1, blank ones too."""
    lines = materialise(_lines(df, source, document, text, {"_key": key}), "lines")
    sequences = frequent_sequences(df, source, document, text, lines=lines, **{"by_block": True, **options})
    marks = sequences.select(F.col("src").alias("_s"), F.explode("lines").alias("_l")).distinct()
    hit = lines.join(materialise(marks, "marks"), F.col("src").eqNullSafe(F.col("_s")) & (F.col("line") == F.col("_l")), "left_semi")
    return hit.select(F.col("_key").alias("key"), "line_no")


def without_repeated_lines(df: DataFrame, key: str, source: str, document: str, text: str, **options: float) -> DataFrame:
    """The table with ``text`` given back without its site's lines; every row stays, null texts stay null.

    ``key`` must tell rows apart.
    """
    hits = repeated_lines(df, key, source, document, text, **options)
    drop = hits.groupBy("key").agg(F.collect_set("line_no").alias("_drop"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    joined = df.select(row, F.col(f"`{key}`").alias("_own")).join(drop, F.col("_own").eqNullSafe(F.col("key")), "left")
    value = F.col(f"_row.`{text}`")
    kept = F.filter(F.split(value, "\n"), lambda _, i: ~F.array_contains("_drop", (i + 1).cast("long")))
    cleaned = F.when(F.col("_drop").isNull(), value).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[(cleaned if c == text else F.col(f"_row.`{c}`")).alias(c) for c in df.columns])


def found(items: DataFrame) -> DataFrame:
    """``arrival, line_no`` of every occurrence of a repeated line in ``body``."""
    return repeated_lines(items, "arrival", "agency_id", "item_id", "body").withColumnRenamed("key", "arrival")


# An equal result in SQL: levels beyond the first never add a line, since every line of a frequent sequence is frequent.
FOUND_SQL = r"""
WITH lines AS (
  SELECT arrival, agency_id, item_id, unnest(string_split(body, chr(10))) AS raw,
         generate_subscripts(string_split(body, chr(10)), 1) AS line_no
  FROM items WHERE body IS NOT NULL
), norm AS (
  SELECT arrival, agency_id, item_id, line_no,
         trim(regexp_replace(regexp_replace(lower(raw), '\p{Nd}+', '0', 'g'), '[^\p{L}\p{N}]+', ' ', 'g')) AS line
  FROM lines
), need AS (
  SELECT agency_id, count(DISTINCT item_id) AS n FROM items GROUP BY agency_id
), frequent AS (
  SELECT agency_id, line FROM norm JOIN need USING (agency_id) WHERE line <> ''
  GROUP BY agency_id, line HAVING count(DISTINCT item_id) >= 5 AND count(DISTINCT item_id) * 25 >= any_value(n)
)
SELECT arrival, CAST(line_no AS BIGINT) AS line_no FROM norm JOIN frequent USING (agency_id, line)
"""

# Every body without those lines, in SQL.
CLEANED_SQL = (
    FOUND_SQL.rsplit("\nSELECT", 1)[0]
    + r""", hits AS (SELECT arrival, list(line_no) AS drop_nos FROM norm JOIN frequent USING (agency_id, line) GROUP BY arrival)
SELECT i.arrival, CASE WHEN h.arrival IS NULL THEN i.body
  ELSE array_to_string(list_filter(string_split(i.body, chr(10)), lambda x, n: NOT list_contains(h.drop_nos, n)), chr(10)) END AS body
FROM items i LEFT JOIN hits h USING (arrival)
"""
)
