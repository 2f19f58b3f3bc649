"""Hard negatives and lexical search: brute force, oracles, edge rows."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tablefit.llm import search_queries
from tablefit.llm.hard_negatives import mine_hard_negatives, strassen
from tablefit.llm.lexical_search import SharedSums, search
from tests.llm.helpers import edge_docs, edge_texts, empty_docs, random_texts
from tools.check_oracle import compare


@pytest.mark.parametrize("name", sorted(search_queries.ORACLES))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, name, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/{sf}/{t}.parquet')")
    want = con.execute(search_queries.ORACLES[name]).df()
    got = search_queries.QUERIES[name](spark, f"/root/testdata/{sf}").toPandas()
    assert len(want) and compare(got, want) == "OK"


# ---- hard negatives ----

def test_strassen_is_exact():
    rng = np.random.default_rng(1)
    for m, k, n in [(1, 1, 1), (3, 0, 4), (17, 17, 17), (33, 64, 70), (100, 65, 31), (128, 128, 128), (5, 200, 90)]:
        a, b = rng.integers(-2**24, 2**24, (m, k)), rng.integers(-2**24, 2**24, (k, n))
        assert (strassen(a, b) == a @ b).all()
        assert (strassen(a, b, leaf=2) == a @ b).all()
    wide = rng.integers(-2**62, 2**62, (40, 40))
    assert (strassen(wide, wide, leaf=4) == wide @ wide).all()  # modulo 2^64


def brute_negatives(rows, step=100, scale=256):
    usable = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own = (label, [math.floor(scale * float(x)) for x in v])
        usable[i] = min(usable.get(i, own), own)

    def score(a, b):
        return sum(x * y for x, y in zip(usable[a][1], usable[b][1]))

    out = []
    for a in usable:
        if a % step:
            continue
        ranked = sorted((-score(a, b), b) for b in usable if b != a)
        for s, p in [(s, b) for s, b in ranked if usable[b][0] == usable[a][0]][:5]:
            inside = [(t, b) for t, b in ranked if usable[b][0] != usable[a][0] and 80 * -s <= 100 * -t <= 100 * -s]
            out += [(a, p, k + 1, b, -s, -t) for k, (t, b) in enumerate(inside[:5])]
    return sorted(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    return sorted(tuple(r) for r in mine_hard_negatives(df, **how).collect())


def test_negatives_against_brute_force(spark, monkeypatch):
    rnd = random.Random(5)
    centre = [[rnd.gauss(0, 1) for _ in range(9)] for _ in range(3)]
    rows = []
    for i in range(600):
        c = centre[i % 3]
        rows.append((i, [float(np.float32(0.25 * round(4 * (x + rnd.gauss(0, 0.4))))) for x in c], rnd.randint(0, 3)))  # many ties
    want = brute_negatives(rows)
    assert len(want) > 50
    assert mined(spark, rows) == want


def test_negatives_with_small_tiles(spark, monkeypatch):
    from tablefit.llm import hard_negatives

    rnd = random.Random(6)
    rows = [(i, [float(np.float32(abs(rnd.gauss(0.5, 0.5)))) for _ in range(20)], rnd.randint(0, 2)) for i in range(700)]
    rows += [(1000 + i, rows[100][1], 2 - rows[100][2] // 2) for i in range(300)]  # a group of equal vectors
    want = brute_negatives(rows)
    monkeypatch.setattr(hard_negatives, "ANCHOR_TILE", 3)
    monkeypatch.setattr(hard_negatives, "CANDIDATE_TILE", 50)
    monkeypatch.setattr(hard_negatives, "SLICE", 7)
    assert mined(spark, rows) == want


def test_negative_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (100, [2.0], 1), (200, [], 1), (300, [1.0, None], 1), (400, None, 1), (500, [nan], 2), (600, [inf, 1.0], 2),
            (None, [5.0, 5.0], 1), (1, [1.0, 1.0], None), (2, [1.0, 1.0], 1), (3, [1.0, 0.9], 2), (3, [1.0, 0.95], 2), (4, [-1.0, -1.0], 1), (5, [-1.0, -1.1], 3), (700, [-3.0, 0.0, 1.0], 3)]
    want = brute_negatives(rows)
    assert want and mined(spark, rows) == want
    clash = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("id", "ints", "rank", "own", "place", "anchor_id", "a.b")})
    assert sorted(tuple(r) for r in mine_hard_negatives(clash).collect()) == want
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == [] and mined(spark, [(100, [1.0], 1)]) == []


# ---- lexical search ----

def brute_search(docs, items, best=10):
    def terms(text):
        lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    holders = Counter(t for _, c, _ in counted for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in wanted.items():
        found = []
        for i, c, n in counted:
            m = 100 - 90 + 90 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if s > 0:
                found.append((-s, float("inf") if i is None else i, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(found, key=lambda f: f[:2])[:best])]
    return sorted(out, key=repr)


def searched(docs, items, **how):
    return sorted((tuple(r) for r in search(docs, items, **how).collect()), key=repr)


def test_shared_sums_hold_every_item():
    rnd = random.Random(2)
    for _ in range(20):
        items = [{f"t{min(int(rnd.expovariate(0.1)), 80)}".encode() for _ in range(rnd.randint(1, 40))} for _ in range(rnd.randint(1, 30))]
        graph = SharedSums(items)
        points = {t: rnd.randint(1, 1000) for t in graph.terms}
        doc = np.zeros(len(graph.terms), dtype=np.int64)
        got = graph.scores(doc, np.arange(len(graph.terms)), np.array([points[t] for t in graph.terms]), 1)
        assert got[:, 0].tolist() == [sum(points[t] for t in it) for it in items]
    # two items with the same terms have one sum, worked out once
    same = SharedSums([{b"a", b"b", b"c"}, {b"a", b"b", b"c"}, {b"a", b"x"}])
    assert same.sums[0] == same.sums[1] and len(same.sums[0]) == 1 and same.levels


@pytest.mark.parametrize("block_terms", [50_000, 25])
def test_search_against_brute_force(spark, block_terms):
    docs = [(i, t) for i, t in enumerate(random_texts(150, 3))] + [(3, "abc"), (4, None), (None, "tie tie"), (900, "tie tie"), (800, "tie tie"), (800, "tie tie"), (801, "")]
    items = [(i, t) for i, t in enumerate(random_texts(12, 4))] + [(50, None), (51, ""), (None, "Tie"), (52, "tie TIE ti"), (52, "abc"), (52, "abc"), (53, "nowhere")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = searched(df, spark.createDataFrame(items, "item_id long, text string"), block_terms=block_terms)
    assert got == brute_search(docs, items)
    assert [r[1:3] for r in got if r[0] == 52][:5]


def test_search_keeps_ties_by_id_over_many_tasks(spark):
    docs = [(i, "same words here") for i in range(2000)]
    items = [(1, "words"), (2, "here words")]
    got = searched(spark.createDataFrame(docs, "doc_id long, text string").repartition(40), spark.createDataFrame(items, "item_id long, text string"))
    assert got == brute_search(docs, items) or not got  # weights may be 0
    docs += [(5000 + i, "other") for i in range(4000)]
    got = searched(spark.createDataFrame(docs, "doc_id long, text string").repartition(40), spark.createDataFrame(items, "item_id long, text string"))
    assert got == brute_search(docs, items) and sorted(r[2] for r in got if r[0] == 1) == list(range(10))


def test_search_edge_rows(spark):
    items = [(1, "word piece"), (2, "a" * 50_000), (3, "漢 two")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("terms", F.lit("x")).withColumn("item", F.lit(1))
    assert searched(edge_docs(spark), bench) == brute_search(edge_texts(), items)
    assert searched(empty_docs(spark), bench) == []
    assert searched(edge_docs(spark), bench.where("item_id > 5")) == []
    assert searched(spark.createDataFrame([(1, None), (2, " .. ")], "doc_id long, text string"), bench) == []
