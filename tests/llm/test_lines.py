"""Line dedup against brute force."""

import random
from collections import defaultdict

from tablefit.llm.line_dedup import BLANKS, drop_repeated_lines
from tests.llm.helpers import edge_docs, edge_texts, empty_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=10, min_docs=2):
    def key(line):
        return line.strip(BLANKS).translate(LOWER)

    last = float("inf")
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(last if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or min(holders[key(x)]) == (last if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df, **how):
    return sorted((tuple(r) for r in drop_repeated_lines(df, **how).collect()), key=repr)


def random_rows(n, seed):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("abAB éÉ漢\t\x0b") for _ in range(rnd.randint(0, 16))) for _ in range(60)] + ["Same line here", " same LINE here\r", "a common line of a third"]
    rows = [(rnd.choice([None, *range(40)]), "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 12)))) for _ in range(n)]
    return [(i, t + "\na common line of a third" if k % 3 == 0 else t) for k, (i, t) in enumerate(rows)]


def test_against_brute_force(spark):
    for seed in (1, 2):
        rows = random_rows(400, seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        assert found(df) == brute(rows)
        assert found(df, min_docs=4, min_chars=5) == brute(rows, 5, 4)


def test_one_common_line_in_many_documents(spark):
    rows = [(i, f"own line of {i}\nthe line that all of them hold\n") for i in range(3000)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_a_line_is_kept_whole_where_it_comes_first(spark):
    rows = [(2, "repeated line\nrepeated line\nx"), (1, "  Repeated LINE\t\nrepeated line"), (3, "repeated line"), (1, "other text\nrepeated line")]
    got = {(r["doc_id"], r["n_lines"]): r for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2, 3]["kept"] == "x" and got[2, 3]["n_dropped"] == 2
    assert got[3, 1]["kept"] == "" and got[3, 1]["n_dropped"] == 1
    assert got[1, 2]["n_dropped"] == 0


def test_edge_rows(spark):
    rows = [*edge_texts(), (70, "many lines of text\n" * 20_000), (71, "\n" * 5000), (72, "many lines of text")]
    want = brute(rows)
    assert found(edge_docs(spark, rows)) == want
    assert any(r[0] == 72 and r[2] == 1 for r in want)
    clash = edge_docs(spark).selectExpr("doc_id", "text", "1 AS id", "2 AS body", "3 AS pos", "4 AS h1", "5 AS n_lines", "6 AS dropped")
    assert found(clash) == brute(edge_texts())
    assert drop_repeated_lines(empty_docs(spark)).collect() == []
