import itertools
import random
import re

from pyspark.sql import functions as F

from claimlake.llm import boilerplate as b


def norm(line):
    return re.sub(r"[^\w]|_", " ", re.sub(r"\d+", "0", line.lower())).strip()


def table(spark, rows):
    return spark.createDataFrame(rows, "arrival long, agency_id string, item_id string, body string")


def make(seed=3, docs=60):
    rng = random.Random(seed)
    rows = []
    for i in range(docs):
        source = rng.choice(["a", "a", "b", None])
        lines = [f"texto {rng.random()}" for _ in range(4)]
        for site in ("© 2024 Site!", "Leia também: as 5 mais", "Compartilhe"):
            if rng.random() < 0.5:
                lines.insert(rng.randrange(len(lines) + 1), site.replace("2024", str(rng.randrange(1990, 2030))))
        rows.append((i, source, f"id{rng.randrange(docs)}", None if rng.random() < 0.1 else "\n".join(lines)))
    return rows


def brute_sequences(rows, length, need_docs, share):
    out = {}
    for source in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == source]
        total = len({r[2] for r in own})
        support = {}
        for _, _, doc, body in own:
            lines = [n for line in (body or "").split("\n") if (n := norm(line))]
            for n in range(1, length + 1):
                for c in set(itertools.combinations(lines, n)):
                    support.setdefault(c, set()).add(doc)
        need = max(need_docs, -(-round(total * share * 1000) // 1000))
        for c, docs in support.items():
            if len(docs) >= need:
                out[(source, c)] = len(docs)
    return out


def test_sequences_against_brute_force(spark):
    rows = make()
    want = brute_sequences(rows, 7, 5, 0.04)
    got = b.frequent_sequences(table(spark, rows), "agency_id", "item_id", "body").collect()
    assert len(got) == len(want) and sorted((str(r["src"]), r["length"], r["documents"]) for r in got) == sorted((str(s), len(c), n) for (s, c), n in want.items())


def test_found_lines_against_brute_force(spark):
    rows = make(9, 120)
    frequent = brute_sequences(rows, 1, 5, 0.04)
    want = {(r[0], i) for r in rows for i, line in enumerate((r[3] or "").split("\n"), 1) if (r[1], (norm(line),)) in frequent}
    assert {tuple(r) for r in b.found(table(spark, rows)).collect()} == want and want


def test_bodies_come_back_without_them(spark):
    rows = [(i, "a", f"d{i}", f"x {chr(97 + i)}\n\n© {i} Site") for i in range(6)] + [(9, "a", "d9", None), (10, "b", "e", "© 1 Site")]
    df = table(spark, rows).withColumn("_drop", F.lit(1))
    out = {r["arrival"]: r["body"] for r in b.without_repeated_lines(df, "arrival", "agency_id", "item_id", "body").collect()}
    assert out[0] == "x a\n" and out[9] is None and out[10] == "© 1 Site" and len(out) == 8


def test_support_counts_documents_not_rows(spark):
    rows = [(i, "a", "same", "linha do site") for i in range(10)]
    assert b.found(table(spark, rows)).count() == 0 and b.found(table(spark, [])).count() == 0


def test_lines_are_taken_from_sequences_of_every_length(spark, monkeypatch):
    rows, mined, mine = make(9, 120), [], b.frequent_sequences

    def spy(*args, **options):
        mined.append(mine(*args, **options).persist())
        mined[-1].count()
        return mined[-1]

    monkeypatch.setattr(b, "frequent_sequences", spy)
    assert b.found(table(spark, rows)).count() > 0
    want = brute_sequences(rows, 7, 5, 0.04)
    got = sorted((str(r["src"]), r["length"], r["documents"]) for r in mined[0].collect())
    assert got == sorted((str(s), len(c), n) for (s, c), n in want.items()) and max(n for _, n, _ in got) > 1


def test_long_footers_end(spark):
    """Thirty lines that stand together, one of them not always, are a few steps and not 2^30 sequences."""
    foot = [f"rodape {chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(30)]
    rows = [(i, "a", f"d{i}", "\n".join([f"x {chr(97 + i)}", *(f for j, f in enumerate(foot) if j != 12 or i % 2), "fim " + chr(97 + i)])) for i in range(12)]
    df = table(spark, rows)
    want = {(r[0], i) for r in rows for i, line in enumerate(r[3].split("\n"), 1) if line in foot}
    assert {tuple(r) for r in b.found(df).collect()} == want
    got = b.frequent_sequences(df, "agency_id", "item_id", "body", by_block=True).groupBy("length").count().collect()
    assert sorted(map(tuple, got)) == [(1, 30), (2, 3), (3, 1)]
