import random

from claimlake.llm import contamination as c

W = [f"palavra{i}" for i in range(40)]


def brute(docs, tests, n=13):
    grams = lambda t: {tuple(w[i : i + n]) for w in [c.words(t)] for i in range(len(w) - n + 1)}
    return {(d, k) for d, t in docs for k, p in tests if grams(t) & grams(p)}


def tables(spark, docs, tests):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(tests, "eval_id long, passage string")


def make():
    rng = random.Random(4)
    tests = [(i, " ".join(rng.choices(W, k=30))) for i in range(12)] + [(50, "é Às vezes, não " * 5), (51, None), (52, "curto")]
    tests.append((99, tests[0][1]))
    docs = []
    for d in range(60):
        p = c.words(rng.choice(tests[:12])[1])
        k, n = rng.randrange(10), rng.choice([11, 12, 13, 14, 20])
        docs.append((d, " ".join(rng.choices(W, k=9)) + " x* " + ", ".join(p[k : k + n]).upper() + " fim."))
    return docs + [(100, None), (101, ""), (102, "E AS VEZES; NAO " * 5), (103, "z " * 30000)], tests


def test_found_against_brute_force(spark):
    docs, tests = make()
    want = brute(docs, tests)
    d, t = tables(spark, docs, tests)
    assert {tuple(r) for r in c.found(d, t).collect()} == want and any(k == 99 for _, k in want) and (102, 50) in want
    joined = c.leaks(d, "doc_id", "text", t, "eval_id", "passage", limit=0)
    assert {(r["key"], r["item"]) for r in joined.collect()} == want


def test_removal(spark):
    docs, tests = make()
    d, t = tables(spark, docs, tests)
    d = d.withColumn("_spans", d.doc_id)
    clean = c.without_leaks(d, "doc_id", "text", t, "eval_id", "passage")
    assert clean.count() == len(docs) and c.found(clean, t).count() == 0 and clean.columns == d.columns
    leaked = {k for k, _ in brute(docs, tests)}
    assert {r["doc_id"] for r in c.without_leaks(d, "doc_id", "text", t, "eval_id", "passage", whole=True).collect()} == {k for k, _ in docs} - leaked
    kept = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert all(kept[k] == v for k, v in docs if k not in leaked)


def test_empty(spark):
    d, t = tables(spark, [], [])
    assert c.found(d, t).count() == 0


def test_removal_keeps_the_text_around_as_it_is(spark):
    """Marks that no composed letter holds, and decomposed letters, before, in and behind the passage."""
    passage = " ".join(f"palavra{i}" for i in range(14))
    leaked = passage.replace("palavra3", "pala\u0301vra3").replace("palavra13", "palavra1\u03033\u0303")
    d, t = tables(spark, [(1, f"e\u0301 q\u0303x antes {leaked} depois\u0301 e\u0301.")], [(1, passage)])
    assert c.without_leaks(d, "doc_id", "text", t, "eval_id", "passage").first()["text"] == "e\u0301 q\u0303x antes  depois\u0301 e\u0301."
    assert [(len(c.words(x)), len(c.places(x))) for x in (leaked, "ΣΑΣ İx ǅ ﬁm")] == [(14, 14), (4, 4)]
