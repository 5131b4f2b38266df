"""New batches checked for duplicates and near-duplicates against everything already accepted.

Method: content-defined chunking.  An address is brought to canonical form and its
name is cut into chunks where a rolling hash of its last bytes says so, so that a
change moves only the ends near it.  A chunk's hash is chained to the chunks before
it, and once more to those after it: two names share the chained chunks of their
common beginning and end.  A persistent table leads from each chunk to the records
that hold it, with its bytes.  A batch reads only the rows of its own chunks; per
pair of records the bytes of shared chunks are summed, their share of the shorter
record decides, and what differs is checked exactly (one edit, or a cut end).
Accepted records are appended with the record they were tied to, so history is
never cut, compared or tied again.

A chunk at the beginning of many names isn't listed for all of them.  One edit leaves
a chunk before it and one after it in common, so for every place it may have only the
rarer of both is looked up.  Where even that one has more than ``LISTED`` records, the
rests of these records meet by what one edit leaves of them (some fifty rows a record,
so listing is cheaper below); both ways find the same pairs.  The tables are bucketed by their keys: a check moves the batch, not the history.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator
from urllib.parse import parse_qsl, unquote, urlsplit

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.session import discard, materialise, shared_dir

#: Least share of the shorter record's bytes that two records of one article have in common; records of a chunk up to
#: which they are listed one by one; words that may be cut off an end; rows of a batch up to which its keys are broadcast.
COVERAGE, LISTED, CUT_WORDS, BROADCAST_ROWS = 0.2, 512, 2, 200_000

#: Least share of a name that is left where its end was cut off.
CUT_SHARE = 0.6

#: Stands for a missing scope.
NO_SCOPE = "(none)"

# Query parameters that track, parts of host and path that only choose a rendering, words that mark a revision,
# and words that carry no meaning in an address.
TRACKING = re.compile(r"(?i)^(?:utm_.*|fbclid|gclid|dclid|msclkid|yclid|igshid|igsh|mc_cid|mc_eid|ref|ref_src|referrer|src|from|share|output|outputtype|amp|_ga|cmpid|origin)$")
RENDERINGS = frozenset(("www", "m", "amp", "mobile", "www2", "amp-html"))
ENDINGS = re.compile(r"\.(?:g|s|x)?html?$|\.php$|\.aspx?$|\.amp$|\.jhtml$")
REVISIONS = frozenset("corrigido corrigida atualizado atualizada atualizacao revisado revisada correcao nova versao errata update updated v2 v3".split())
EMPTY_WORDS = frozenset("a o as os um uma uns umas e de da do das dos em na no nas nos que ao aos por para com se the of in on and to el la los las y".split())

_GEAR = tuple(xxhash.xxh32_intdigest(bytes([i])) for i in range(256))
_MASK = 0x1C  # three bits that depend on the last five bytes: chunks of eight bytes on average


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of ``data`` end; a change of one byte moves only ends within five bytes of it."""
    h, ends = 0, []
    for i, b in enumerate(data, 1):
        h = ((h << 1) + _GEAR[b]) & 0xFFFFFFFF
        if not h & _MASK:
            ends.append(i)
    if not ends or ends[-1] != len(data):
        ends.append(len(data))
    return ends


def address(url: str | None) -> tuple[str, str, str, int]:
    """``(name, numbers, place, words)``: what an address names, its numbers, where the page is filed, its word count.

    Not part of a name: scheme, host, case, percent-encoding, tracking parameters,
    fragment, ending, rendering, section and date directories, revision marks and
    words without meaning.
    """
    try:
        parts = urlsplit((url or "").strip())
    except ValueError:
        return (url or "").lower(), "", "", 1
    segments = [s for s in unquote(parts.path).lower().split("/") if s and s not in RENDERINGS]
    slug = ENDINGS.sub("", segments.pop()) if segments else ""
    if slug == "index" and segments:
        slug = segments.pop()
    query = sorted((k.lower(), v.lower()) for k, v in parse_qsl(parts.query, keep_blank_values=True) if not TRACKING.match(k))
    raw = [w for w in re.split(r"[^\w]+|_", slug) if w]
    while len(raw) > 1 and (raw[-1] in REVISIONS or (raw[-1].isdigit() and len(raw) > 2 and raw[-2] in REVISIONS)):
        # The number of an article may stand after the mark.
        raw.pop(-2 if raw[-1].isdigit() else -1)
    numbers = [w for w in raw if any(c.isdigit() for c in w)] + [f"{k}={v}" for k, v in query]
    named = [w for w in raw if w not in EMPTY_WORDS and not any(c.isdigit() for c in w)]
    count = sum(not any(c.isdigit() for c in w) for w in raw)
    if not named and not numbers:
        return "/".join([*segments, slug]), "", "", count
    return "-".join(named), " ".join(numbers), "/".join(segments), count


#: Rows of a chunk behind which no chunk survives an edit; rows of a whole name, and of one without its last words.
_AT_END, _WHOLE, _LONGER = "place > 0 and mate = 0", "place = 0 and mate = 1", "place = 0 and mate = 2"
_PIECE = "key long, node long, place int, bytes int, mate int, bag long"


def pieces(name: str, seed: int) -> list[tuple[int, int, int, int]]:
    """``(key, place, bytes, mate)`` of each chained chunk of a name.

    ``place`` is the number of chunks up to the end of one that is chained to the
    beginning, and minus that number for the one that begins there and is chained to
    the end.  ``mate`` of the former is the place where the chain from the end goes on
    behind one edit of the next chunk (0 if the edit may reach the end), of the latter
    1 if an edit of the first chunk leaves it.  Place 0 is the chain before the last
    chunk together with the size of the name (``mate`` 1), or with that of the name
    without its last words (``mate`` 2), as a name that ends there would have it.
    """
    data = name.encode()
    size, bounds = len(data), [0, *chunk_ends(data)]
    count = len(bounds) - 1
    # A swap covers two characters, and an end depends on the last five bytes.
    reach = 4 + 2 * (1 if name.isascii() else 4)

    def behind(i: int) -> int:
        """The place behind an edit of the chunk that begins at place ``i``."""
        j = bisect.bisect_left(bounds, bounds[i + 1] + reach)
        return j if j < count else 0

    out, chain, chains = [], seed, [seed]
    for i in range(1, count):
        own = data[bounds[i - 1] : bounds[i]]
        chain = xxhash.xxh64_intdigest(own, seed=chain)
        chains.append(chain)
        out.append((chain - 2**63, i, len(own), behind(i)))
    end = size
    for words in range(CUT_WORDS + 1):
        if words:
            end = data.rfind(b"-", 0, end)
        last = bisect.bisect_left(bounds, end) - 1
        if last < 1:
            break
        out.append((xxhash.xxh64_intdigest(end.to_bytes(8), seed=chains[last]) - 2**63, 0, 0, 2 if words else 1))
    chain, first = seed ^ 0xFFFFFFFF, behind(0)
    for i in range(count - 1, 0, -1):
        own = data[bounds[i] : bounds[i + 1]]
        chain = xxhash.xxh64_intdigest(own, seed=chain)
        out.append((chain - 2**63, -i, len(own), int(i == first)))
    return out


def bag(name: str) -> int:
    """Which characters a name holds an odd number of times, as bits; one edit changes two of them at most, a swap none."""
    bits = 0
    for c in name:
        bits ^= 1 << ord(c) % 63
    return bits


def rests(name: str, place: int) -> list[str]:
    """What an edit leaves of the part of a name that a common chunk doesn't cover: the part, its characters in order, and it without one of them.

    An edit behind a chunk from the beginning lies in the next chunk.
    """
    data = name.encode()
    bounds = [0, *chunk_ends(data)]
    at = bounds[abs(place)]
    rest = (data[at:] if place > 0 else data[:at]).decode(errors="surrogateescape")
    region = len(data[at : bounds[place + 1]].decode(errors="surrogateescape")) if place > 0 else len(rest)
    return [rest, "\x00" + "".join(sorted(rest)), *{rest[:k] + rest[k + 1 :] for k in range(region)}]


def _flat_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, scope, numbers, name`` to one row of ``_PIECE`` per chained chunk."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), *((c, pa.int32()) for c in ("place", "bytes", "mate")), ("bag", pa.int64())])
    for batch in batches:
        columns: list[list] = [[] for _ in schema]
        for node, scope, numbers, name in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            bits = bag(name)
            for key, place, own, mate in pieces(name, xxhash.xxh64_intdigest(f"{scope}\x00{numbers}")):
                for column, value in zip(columns, (key, node, place, own, mate, bits), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _rests_udf(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for keys, names, places in batches:
        yield pd.Series([
            [xxhash.xxh64_intdigest(r.encode(errors="surrogateescape"), seed=k + 2**63) - 2**63 for r in rests(n, p)] for k, n, p in zip(keys, names, places, strict=True)
        ])


_ADDRESS = T.StructType().add("name", "string").add("numbers", "string").add("place", "string").add("words", "integer")


@F.pandas_udf(_ADDRESS)
def _address_udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for urls in batches:
        yield pd.DataFrame([address(u) for u in urls], columns=["name", "numbers", "place", "words"])


def records(df: DataFrame, scope: str, record: str, url: str, rank: str) -> DataFrame:
    """Rows as ``scope, record, rank, node, name, numbers, place, words``; ``node`` is one article name within a scope.

    A null url or record counts as an empty string; null and empty scopes are one, ``NO_SCOPE``.
    """
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    named_scope = F.coalesce(F.nullif(F.col(f"`{scope}`").cast("string"), F.lit("")), F.lit(NO_SCOPE))
    base = df.select(named_scope.alias("scope"), text(record).alias("record"), F.col(f"`{rank}`").alias("rank"), _address_udf(F.col(f"`{url}`")).alias("a"))
    named = base.select("scope", "record", "rank", F.xxhash64("scope", "a.numbers", "a.name").alias("node"), "a.name", "a.numbers", "a.place", "a.words")
    return materialise(named, "records")


class ChunkIndex:
    """The persistent tables of accepted records, each bucketed by its first column.

    ``chunks`` leads from a chunk (or a record's id) to the names that hold it,
    ``nodes`` from a name to the accepted record of its article, ``moves`` from an
    article to the one it turned out to be.  A batch is written under a number of its
    own and seen once its marker stands: what a failed job left behind never counts.
    ``path`` keeps an index beyond the session; without it the index ends with it.
    ``buckets`` counts when an index is made, by default as many as the session's shuffle partitions.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, *, buckets: int | None = None, listed: int = LISTED) -> None:
        self.spark, self.path, self.listed = spark, path or f"{shared_dir(spark)}/chunks", listed
        self._name = f"chunk_index_{xxhash.xxh64_hexdigest(self.path)}"
        held = self._markers("buckets")
        if not held:
            held = [buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))]
            self._mark("buckets", held[0])
        self.buckets = held[0]

    # What is stored

    def _markers(self, kind: str) -> list[int]:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        home = hadoop.Path(f"{self.path}/{kind}")
        fs = home.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(home)) if fs.exists(home) else []

    def _mark(self, kind: str, number: int) -> None:
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/{number}")
        marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(marker).close()

    @property
    def batches(self) -> int:
        """How many batches have been accepted."""
        return len(self._markers("done"))

    def _begin(self) -> int:
        number = max([0, *self._markers("begun")]) + 1
        self._mark("begun", number)
        return number

    def _insert(self, kind: str, rows: DataFrame, number: int) -> None:
        by, table = rows.columns[0], f"{self._name}_{kind}"
        rows = rows.withColumn("batch", F.lit(number))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        place = f"{self.path}/{kind}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({fields}) USING parquet CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{place}'")
        rows.repartition(self.buckets, by).write.insertInto(table)
        self.spark.catalog.refreshTable(table)
        self._mark(f"kinds/{kind}", number)

    def _stored(self, kind: str, *also: int) -> DataFrame | None:
        """A table over the accepted batches and those given; None if there is none of them."""
        numbers = [n for n in self._markers(f"kinds/{kind}") if n in {*self._markers("done"), *also}]
        if not numbers:
            return None
        table = f"{self._name}_{kind}"
        if not self.spark.catalog.tableExists(table):  # another session made it
            place = f"{self.path}/{kind}"
            like, by = self.spark.read.parquet(place), {"chunks": "key", "nodes": "node", "moves": "root"}[kind]
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
            self.spark.sql(f"CREATE TABLE {table} ({fields}) USING parquet CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{place}'")
        return self.spark.table(table).filter(F.col("batch").isin(numbers))

    # A batch

    def append(self, rows: DataFrame) -> None:
        """Adds records (as ``records`` gives them), each tied to the accepted record of its article."""
        number, nodes, ties, moves = self._tie(rows)
        tied = nodes.join(ties, "node", "left").select("node", "name", "place", "words", F.coalesce("label", _own_label()).alias("label"))
        self._insert("nodes", tied, number)
        if moves is not None:
            self._insert("moves", moves, number)
        self._mark("done", number)
        discard(nodes, ties, moves)

    def check(self, rows: DataFrame) -> DataFrame:
        """``scope, record, rank, accepted``: for each record of a batch the accepted record of its article, null for a first one.

        The accepted record is the stored one of all records whose addresses or ids
        link them, else the least by ``rank`` of the batch's own.  Nothing is added.
        """
        _, nodes, ties, _ = self._tie(rows)
        own = nodes.join(ties, "node", "left").select("scope", "node", F.coalesce("label", _own_label()).alias("label"))
        before = ~F.col("label.new") | (F.col("label.rank") < F.col("rank"))
        return rows.join(own, ["scope", "node"]).select("scope", "record", "rank", F.when(before, F.col("label.record")).alias("accepted"))

    def _tie(self, rows: DataFrame) -> tuple[int, DataFrame, DataFrame, DataFrame | None]:
        """The batch's number, its names, ``node, label`` of those that are linked or stored, and the stored articles that it joins."""
        number = self._begin()
        nodes = rows.groupBy("scope", "node").agg(
            F.min(F.struct("rank", "record")).alias("first"), F.first("name").alias("name"), F.first("numbers").alias("numbers"), F.min(F.struct("rank", "place"))["place"].alias("place"), F.min("words").alias("words")
        )
        nodes = materialise(nodes, "nodes")
        stored = self._stored("nodes")
        # A name that is stored has its answer by itself; only new ones are cut into chunks.
        fresh = nodes.select("node", "scope", "numbers", "name")
        if stored is not None:
            fresh = fresh.join(stored.select("node"), "node", "left_anti")
        # A record's id is one more thing that its names share; it has no bytes of the name.
        nothing = [*[F.lit(0).alias(c) for c in ("place", "bytes", "mate")], F.lit(0).cast("long").alias("bag")]
        ids = rows.filter("record <> ''").select(F.xxhash64(F.lit("id"), "scope", "record").alias("key"), "node", *nothing)
        self._insert("chunks", fresh.mapInArrow(_flat_pieces, _PIECE).unionByName(ids.distinct()), number)
        shared = self._shared(number)
        facts = nodes.select("node", "name", "place", "words")
        pairs = _candidates(shared, lambda some: self._facts(facts, stored, some), self.listed)
        near = _judge(pairs, self._facts(facts, stored, pairs.select(F.explode(F.array("x", "y")).alias("node"))))
        judged = _covered(near, shared)
        by_id = _same_record(shared)
        discard(shared, pairs, near)
        # Stored names stand for the articles they were tied to.
        own = nodes.select("node", _own_label().alias("label"))
        known = None
        if stored is not None:
            some = by_id.select(F.explode(F.array("a", "b")).alias("node")).unionByName(judged.select(F.explode(F.array("x", "y")).alias("node"))).unionByName(nodes.select("node"))
            known = materialise(self._settled(stored.join(some.distinct(), "node", "left_semi").select("node", "label")), "known")
        sure = by_id.unionByName(judged.filter("not cut").select(F.col("x").alias("a"), F.col("y").alias("b")))
        cuts = materialise(_cut(judged.filter("cut"), _spread(sure, own, known)), "cuts")
        ties = _spread(sure.unionByName(cuts), own, known)
        moves = None
        if known is not None:
            moved = known.select("node", F.col("label").alias("was")).join(ties, "node").filter("was.root <> label.root")
            moved = materialise(moved.groupBy(F.col("was.root").alias("root")).agg(F.min("label").alias("label")), "moves")
            moves = moved if moved.head(1) else None
        discard(by_id, judged, known, cuts)
        return number, nodes, ties, moves

    def _shared(self, number: int) -> DataFrame:
        """The rows of the batch's chunks that more than one name holds, and whether a row is the batch's own (``mine``).

        ``n`` is how many hold the chunk; for a chunk with nothing behind an edit, how many hold it so.
        """
        held = self._stored("chunks", number)
        own = held.filter(F.col("batch") == number)
        # The size of a batch decides how its keys reach the history; neither way moves the history.
        if self._stored("chunks") is not None and own.count() <= BROADCAST_ROWS:
            keys = materialise(own.select("key").distinct(), "keys")
            held = held.join(F.broadcast(keys), "key", "left_semi")
        counts = held.groupBy("key").agg(F.count("*").alias("n"), F.count_if(F.expr(_AT_END)).alias("at_end"), F.max(F.col("batch") == number).alias("_own")).filter("n > 1 and _own")
        n = F.when(F.expr(_AT_END), F.col("at_end")).otherwise(F.col("n"))
        rows = held.join(counts.drop("_own"), "key").withColumns({"mine": F.col("batch") == number, "n": n}).drop("batch", "at_end")
        return materialise(rows, "shared")

    @staticmethod
    def _facts(own: DataFrame, stored: DataFrame | None, some: DataFrame) -> DataFrame:
        """``node, name, place, words`` of the names of the batch and of those of ``some`` that are stored."""
        if stored is None:
            return own
        return own.unionByName(stored.select("node", "name", "place", "words").join(some.select("node").distinct(), "node", "left_semi")).dropDuplicates(["node"])

    def _settled(self, known: DataFrame) -> DataFrame:
        """``node, label`` with each article replaced by the one it has become, by as many steps as there were."""
        moves = self._stored("moves")
        # A name is stored once for each batch that held it, the first time under its article.
        known = known.groupBy("node").agg(F.min("label").alias("label"))
        label = F.struct(F.lit(False).alias("new"), "label.rank", "label.record", "label.root")
        known = known.select("node", label.alias("label"))
        while moves is not None:
            to = moves.select(F.col("root").alias("_root"), F.struct(F.lit(False).alias("new"), "label.rank", "label.record", "label.root").alias("_to"))
            known = materialise(known.join(to, F.col("label.root") == F.col("_root"), "left").select("node", F.coalesce("_to", "label").alias("label"), F.col("_to").isNotNull().alias("moved")), "settled")
            if not known.filter("moved").head(1):
                return known.drop("moved")
            known = known.drop("moved")
        return known


def _own_label() -> Column:
    """The label of a name that no other is tied to yet: its first record, and itself as the article."""
    return F.struct(F.lit(True).alias("new"), "first.rank", "first.record", F.col("node").alias("root"))


def _same_record(shared: DataFrame) -> DataFrame:
    """Edges between nodes that hold the same record id."""
    ids = shared.filter("place = 0 and mate = 0").select("key", "node")
    least = ids.groupBy("key").agg(F.min("node").alias("a"))
    return materialise(ids.join(least, "key").filter("node <> a").select("a", F.col("node").alias("b")).distinct(), "same_record")


def _candidates(shared: DataFrame, facts: Callable[[DataFrame], DataFrame], listed: int) -> DataFrame:
    """``x, y, cut``: pairs of names that share the chunks which one edit or a cut end leaves in common."""
    mine = shared.filter("mine and place <> 0").select("node", F.struct("place", "n", "key", "mate", "bag").alias("piece"))
    held = mine.groupBy("node").agg(F.collect_list("piece").alias("pieces"))  # as many as a name has chunks
    after = F.map_from_entries(F.transform(F.filter("pieces", lambda p: p["place"] < 0), lambda p: F.struct(-p["place"], p)))

    def rarer(front: Column) -> Column:
        back = F.try_element_at(F.col("after"), front["mate"])
        return F.when(front["mate"] == 0, front).when(back.isNotNull(), F.when(front["n"] <= back["n"], front).otherwise(back))

    chosen = F.concat(
        F.transform(F.filter("pieces", lambda p: p["place"] > 0), rarer), F.filter("pieces", lambda p: (p["place"] < 0) & (p["mate"] == 1))
    )
    probes = held.withColumn("after", after).select(F.col("node").alias("x"), F.explode(F.array_distinct(F.filter(chosen, lambda p: p["n"] > 1))).alias("p"))
    # Where an edit may reach the end of one spelling it may in the other.
    probes = materialise(probes.select("x", "p.key", "p.n", ((F.col("p.place") > 0) & (F.col("p.mate") == 0)).alias("at_end"), F.col("p.bag").alias("x_bag")), "probes")
    few = shared.filter((F.col("place") != 0) & (F.col("n") <= listed)).select("key", F.expr(_AT_END).alias("y_end"), F.col("node").alias("y"), F.col("bag").alias("y_bag"))
    # One edit changes two bits at most; what else a common chunk's names have is told apart here.
    near = probes.filter(F.col("n") <= listed).join(few, "key").filter((F.col("x") != F.col("y")) & (F.bit_count(F.col("x_bag").bitwiseXOR(F.col("y_bag"))) <= 2) & (~F.col("at_end") | F.col("y_end"))).select("x", "y")
    pairs = near.unionByName(_of_common(probes.filter(F.col("n") > listed), shared, facts))
    pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), F.lit(False).alias("cut"))
    # A cut name's last chunk and size are those of the longer name without its last words.
    short = shared.filter(_WHOLE).select("key", F.col("node").alias("x"), F.col("mine").alias("x_mine"))
    long = shared.filter(_LONGER).select("key", F.col("node").alias("y"), F.col("mine").alias("y_mine"))
    cut = short.join(long, "key")
    open_ = cut.filter("x_mine or y_mine").select("x").distinct()
    cut = cut.join(open_, "x", "left_semi").select("x", "y", F.lit(True).alias("cut"))
    found_ = materialise(pairs.unionByName(cut).distinct(), "candidates")
    discard(probes)
    return found_


def _of_common(probes: DataFrame, shared: DataFrame, facts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``x, y`` of the names that share a common chunk and have rests one edit apart.

    Rests one edit apart are equal without one character each, or have the same
    characters; no pair of a common chunk's names is listed for any other reason.
    """
    keys = probes.groupBy("key").agg(F.min("at_end").alias("at_end"))
    members = shared.filter("place <> 0").join(keys, "key").filter(~F.col("at_end") | F.expr(_AT_END))
    members = members.select("key", "node", "place", "mine").join(facts(members).select("node", "name"), "node")
    left = members.select("node", "mine", F.explode(F.array_distinct(_rests_udf("key", "name", "place"))).alias("left"))
    left = materialise(left, "rests")
    met = left.groupBy("left").agg(F.count("*").alias("n"), F.max("mine").alias("mine")).filter("n > 1 and mine")
    kept = materialise(left.join(met.select("left"), "left", "left_semi"), "met")
    x, y = kept.alias("x"), kept.alias("y")
    both = x.join(y, (F.col("x.left") == F.col("y.left")) & F.col("x.mine") & (F.col("x.node") != F.col("y.node")))
    pairs = both.select(F.col("x.node").alias("x"), F.col("y.node").alias("y"))
    discard(left)
    return pairs


def _covered(pairs: DataFrame, shared: DataFrame) -> DataFrame:
    """The pairs of which shared chunks cover ``COVERAGE`` of the shorter record."""
    held = shared.filter("place <> 0").select("node", "key", "bytes")
    left = held.select(F.col("node").alias("x"), "key", "bytes")
    by = ("x", "y", "cut", "same_place", "size")
    total = pairs.join(left, "x").join(held.select(F.col("node").alias("y"), "key"), ["y", "key"]).groupBy(*by).agg(F.sum("bytes").alias("bytes"))
    return materialise(total.filter(F.col("bytes") >= COVERAGE * F.col("size")).drop("bytes", "size"), "covered")


def _judge(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """``x, y, cut, same_place, size`` (of the shorter) of the pairs whose difference is one edit within a word, or a cut end."""
    facts = facts.select("node", "name", F.hash("place").alias("place"), "words")
    sides = [facts.select(*[F.col(c).alias(f"{side}_{c}" if c != "node" else side) for c in facts.columns]) for side in "xy"]
    both = pairs.join(sides[0], "x").join(sides[1], "y")
    a, b = F.col("x_name"), F.col("y_name")
    gap = F.levenshtein(a, b, 2)
    # Two characters of one word may have changed places.
    differ = F.filter(F.zip_with(F.split(a, "-"), F.split(b, "-"), lambda p, q: ~p.eqNullSafe(q)), lambda d: d)
    swapped = (gap == 2) & (F.length(a) == F.length(b)) & (F.size(differ) == 1) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    # The words without meaning count: "and in another place" adds more of them than a cut takes.
    more = F.size(F.split(b, "-")) - F.size(F.split(a, "-"))
    ends = b.startswith(F.concat(a, F.lit("-"))) & more.between(1, CUT_WORDS) & (F.col("y_words") - F.col("x_words") <= CUT_WORDS)
    right = F.when(F.col("cut"), ends & (F.octet_length(a) >= CUT_SHARE * F.octet_length(b))).otherwise((gap == 1) | swapped)
    same, size = F.col("x_place") == F.col("y_place"), F.least(F.octet_length(a), F.octet_length(b))
    return materialise(both.filter(right).select("x", "y", "cut", same.alias("same_place"), size.alias("size")), "judged")


def _cut(cut: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges from a name whose end was cut off to the one article that goes on from it.

    ``cut`` is as ``_judge`` gives it; ``labels`` joins the spellings of one article, which count once.
    """
    # A cut address that several articles go on from names none of them, unless only one is filed in its place.
    named = labels.select(F.col("node").alias("y"), F.col("label.root").alias("root"))
    article = F.coalesce("root", "y")
    votes = (
        cut.join(named, "y", "left")
        .groupBy("x")
        .agg(
            F.count_distinct(article).alias("any"),
            F.count_distinct(F.when(F.col("same_place"), article)).alias("near"),
            F.min("y").alias("only"),
            F.min(F.when(F.col("same_place"), F.col("y"))).alias("here"),
        )
    )
    chosen = F.when(F.col("near") == 1, F.col("here")).otherwise(F.col("only"))
    return votes.filter("near = 1 OR any = 1").select(F.col("x").alias("a"), chosen.alias("b"))


def _spread(edges: DataFrame, own: DataFrame, known: DataFrame | None) -> DataFrame:
    """``node, label`` of the linked names of the batch and of the stored ones in ``known``: the least label of each component.

    Labels spread along the edges until none changes; components are the spellings
    of one article, so this takes a few rounds over the (few) linked nodes.  A stored
    name stands for its article, whose other names need not be read.
    """
    linked = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    stands = own.join(linked, "node", "left_semi")
    if known is None:
        stands = stands.select("node", F.col("node").alias("at"), "label")
    else:
        old = known.select("node", F.col("label.root").alias("at"), "label")
        stands = stands.join(known, "node", "left_anti").select("node", F.col("node").alias("at"), "label").unionByName(old)
    stands = materialise(stands, "stands")
    at = stands.select("node", "at")
    arcs = edges.join(at.withColumnsRenamed({"node": "a", "at": "p"}), "a").join(at.withColumnsRenamed({"node": "b", "at": "q"}), "b").filter("p <> q")
    arcs = materialise(arcs.select(F.explode(F.array(F.struct("p", "q"), F.struct(F.col("q").alias("p"), F.col("p").alias("q")))).alias("e")).select("e.*").distinct(), "arcs")
    joined = arcs.select(F.col("p").alias("at")).distinct()
    labels = materialise(stands.join(joined, "at", "left_semi").groupBy("at").agg(F.min("label").alias("label")), "labels")
    while labels.head(1):
        around = arcs.join(labels.select(F.col("at").alias("q"), F.col("label").alias("other")), "q").groupBy("p").agg(F.min("other").alias("other"))
        moved = labels.join(around, F.col("at") == F.col("p")).select("at", F.least("label", "other").alias("label"), (F.col("other") < F.col("label")).alias("changed"))
        moved, before = materialise(moved, "labels"), labels
        labels = moved.drop("changed")
        discard(before)
        if not moved.filter("changed").head(1):
            break
    spread = labels.withColumnRenamed("label", "_label")
    ties = materialise(stands.join(spread, "at", "left").select("node", F.coalesce("_label", "label").alias("label")), "ties")
    discard(stands, arcs)
    return ties


def found(items: DataFrame, seen: DataFrame) -> DataFrame:
    """``arrival, accepted_item_id`` of every item whose article is already accepted, in ``seen`` or by an earlier arrival."""
    index = ChunkIndex(items.sparkSession)
    rank = lambda source, order: F.struct(F.lit(source).alias("source"), order.alias("order"), F.coalesce("item_id", F.lit("")).alias("id"))
    history = seen.select("agency_id", "item_id", "canonical_url", rank(0, F.lit(0).cast("long")).alias("rank"))
    index.append(records(history, "agency_id", "item_id", "canonical_url", "rank"))
    batch = items.select("agency_id", "item_id", "canonical_url", rank(1, F.col("arrival").cast("long")).alias("rank"))
    checked = index.check(records(batch, "agency_id", "item_id", "canonical_url", "rank"))
    return checked.filter("accepted is not null").select(F.col("rank.order").alias("arrival"), F.col("accepted").alias("accepted_item_id"))
