"""Rows that every operator on documents must take: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, id long, fp long, key string, score double, n_words string, kept boolean, items string, `a.b` int, votes long"


def random_texts(n, seed=1):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeéß漢") for _ in range(rnd.randint(1, 7))) for _ in range(120)]
    return [" ".join(rnd.choice(words) + rnd.choice(["", "", ",", ".", ".\n"]) for _ in range(rnd.randint(1, 80))) for _ in range(n)]


def edge_texts():
    texts = random_texts(20)
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "x"), (5, texts[0]), (6, texts[0]), (6, texts[0]), (None, texts[1]), (None, None), (7, texts[1]),
        (8, "word " * 30_000), (9, "a" * 50_000), (10, "\u0000 nul \u2581 piece  two   three    spaces "), (10, texts[2]),
        *[(20 + i, t) for i, t in enumerate(texts)],
    ]


def edge_docs(spark, rows=None):
    rows = edge_texts() if rows is None else rows
    data = [(i, t, "en", 7, None, "k", 0.5, "n", None, "i", 3, 9) for i, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
