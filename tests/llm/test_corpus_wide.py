"""SimHash near-dedup, suffix-array dedup, toxicity and the pipeline: brute force, held-out accuracy, edge rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tablefit.llm import simhash, suffix_dedup, suffix_sort, text_queries, toxicity
from tablefit.llm.components import connected_components
from tests.llm.helpers import edge_docs, edge_texts, empty_docs, random_texts


# ---- SimHash ----

def brute_fingerprint(text, width=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    votes = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def brute_components(values, radius):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    rnd = random.Random(radius)
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(5000):
        flips = sum(1 << b for b in rnd.sample(range(64), radius))
        assert any(not m & flips for m in masks)


@pytest.mark.parametrize("bucket", [2048, 3])
def test_links_join_all_values_within_the_radius(spark, bucket, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rnd = random.Random(8)
    values = {rnd.getrandbits(64) for _ in range(150)}
    for v in list(values)[:60]:
        for _ in range(rnd.randint(1, 12)):
            for b in rnd.sample(range(64), rnd.randint(1, 5)):
                v ^= 1 << b
            values.add(v)
    values = sorted(values)
    df = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    links = simhash.fingerprint_links(df, 4)
    at = {simhash._signed(v): i for i, v in enumerate(values)}
    pairs = [(at[r["a"]], at[r["b"]]) for r in links.collect()]
    assert all(1 <= (values[a] ^ values[b]).bit_count() <= 4 for a, b in pairs)
    got = list(range(len(values)))
    for r in connected_components(links).collect():
        got[at[r["node"]]] = at[r["root"]]
    want = brute_components(values, 4)
    assert len({*zip(got, want, strict=True)}) == len(set(got)) == len(set(want))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(100, 160)] + [(5, 5), (None, 3), (7, 6), (7, 6)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in [*range(100, 160), 1000]}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_a_million_links(spark):
    links = spark.range(1_000_000).selectExpr("id + id div 7 + 1 AS a", "8 * (id div 7) AS b")  # stars of eight nodes
    got = connected_components(links)
    assert got.count() == got.where("root = node - node % 8").count() == 1_142_858


def test_simhash_query_against_brute_force(spark, sf_small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()}
    ids = sorted(docs)
    values = [brute_fingerprint(docs[i]) for i in ids]
    want = {(i, f"{v:016x}", ids[r]) for i, v, r in zip(ids, values, brute_components(values, 4), strict=True)}
    assert {tuple(r) for r in text_queries.op3_simhash(spark, sf_small).select("doc_id", "fingerprint", "component_id").collect()} == want


def test_simhash_edge_rows(spark):
    rows = simhash.simhash_components(edge_docs(spark)).collect()
    texts = edge_texts()
    values = [brute_fingerprint(t) for _, t in texts]
    groups = brute_components(values, 4)
    least = {g: min((i for (i, _), h in zip(texts, groups, strict=True) if h == g and i is not None), default=None) for g in groups}
    want = [(i, f"{v:016x}", least[g]) for (i, _), v, g in zip(texts, values, groups, strict=True)]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert simhash.simhash_components(empty_docs(spark)).count() == 0
    kept = simhash.drop_near_copies(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, least.values()))


# ---- suffix arrays ----

def test_suffix_arrays_and_common_prefixes():
    rnd = random.Random(3)
    for _ in range(120):
        alphabet = rnd.choice([b"ab", b"abc", b"\0a", b"a", bytes(range(200))])
        texts = [bytes(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(rnd.randint(1, 8))]
        texts += [texts[0] + texts[-1], b"a" * rnd.randint(0, 40)]
        block = suffix_sort.Block(texts)
        suffixes = {int(block.starts[i]) + j: t[j:] for i, t in enumerate(texts) for j in range(len(t))}
        for depth in (8, 20, 100):
            order = suffix_sort.suffix_array(block, depth).tolist()
            assert sorted(order) == sorted(suffixes)
            cut = [suffixes[p][:depth] for p in order]
            assert cut == sorted(cut)
            lengths = [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(cut, cut[1:])]
            assert suffix_sort.common_prefixes(block, np.array(order, dtype=np.int64), depth).tolist() == lengths


def brute_repeats(rows, length=100):
    seen, out = set(), {}
    for key, text in rows:
        gone = bytearray(len(text))
        for p in range(len(text) - length + 1):
            w = text[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out[key] = (len(text), sum(gone), sum(1 for k in range(len(text)) if gone[k] and (k == 0 or not gone[k - 1])), hashlib.sha256(kept).hexdigest())
    return out


def repeating_rows():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    shared, bases, rows = prose(60), [prose(150) for _ in range(4)], []
    for i in range(150):
        r = rnd.random()
        if r < 0.3:
            t = f"{prose(rnd.randint(5, 100))} {shared} {prose(rnd.randint(1, 50))}"
        elif r < 0.5:
            t = rnd.choice(bases)
        elif r < 0.7:
            t = rnd.choice(bases).split()
            t[rnd.randrange(len(t))] = "xx"
            t = " ".join(t)
        elif r < 0.78:
            t = rnd.choice(["a", "ab", "\0"]) * rnd.randint(0, 400)
        elif r < 0.82:
            t = shared * 2
        else:
            t = prose(rnd.randint(0, 60))
        rows.append((3 * i + 1, t))
    return rows


@pytest.mark.parametrize("most", [suffix_dedup.BLOCK_MOST, 1500])
def test_repeats_against_brute_force(spark, most):
    rows = repeating_rows()
    docs = edge_docs(spark, rows)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.remove_repeats(docs, block_most=most).collect()}
    assert got == brute_repeats([(i, t.encode()) for i, t in rows])


@pytest.mark.parametrize("most", [suffix_dedup.BLOCK_MOST, 1500])
def test_repeated_rows_keep_the_first_occurrence(spark, most):
    alone = " ".join(f"only{i}here" for i in range(40))
    near = " ".join(f"word{i}" for i in range(80))
    rows = [*repeating_rows(), (1001, alone), (1002, near), (1003, near + " and an end of its own"), (1004, "x " * 300)]
    got = [(r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]))
           for r in suffix_dedup.remove_repeats(edge_docs(spark, rows * 3), block_most=most).collect()]
    want = brute_repeats([(i, t.encode()) for i, t in rows])
    assert want[1001][1] == want[1002][1] == 0 < want[1003][1]
    assert sorted(got) == sorted([*want.items()] * 3)


@pytest.mark.parametrize("one_id", [None, 7])
@pytest.mark.parametrize("most", [suffix_dedup.BLOCK_MOST, 50_000])
def test_thousands_of_texts_of_one_id_are_documents_of_their_own(spark, one_id, most):
    rnd = random.Random(6)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(150))
    texts = [f"{i} {rnd.random()} " + (passage if i % 4 else "") + f" {rnd.random()} of {i}" for i in range(4000)] + [repeating_rows()[0][1]] * 2
    df = spark.createDataFrame([(one_id, t) for t in texts], "doc_id long, text string").repartition(6)
    order = df.select("text", F.xxhash64(F.lit(1), "text").alias("h"), F.xxhash64("text").bitwiseAND(F.lit((1 << suffix_dedup.TAG_BITS) - 1)).alias("g")).distinct()
    docs = [(r["text"], r["text"].encode()) for r in order.orderBy("h", "g").collect()]
    want = brute_repeats(docs)
    got = suffix_dedup.remove_repeats(df, block_most=most).collect()
    assert {r["doc_id"] for r in got} == {one_id}
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted(want[t] for t in texts)
    assert sum(r["n_removed"] == 0 for r in got) >= 1001


def test_repeats_query_against_brute_force(spark, sf_small):
    docs = sorted((r["doc_id"], (r["text"] or "").encode()) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in text_queries.op10_suffix_dedup(spark, sf_small).collect()}
    assert got == brute_repeats(docs)


def test_texts_longer_than_a_piece(monkeypatch, spark):
    monkeypatch.setattr(suffix_dedup, "PIECE", 4096)
    rows = [(i, t * 3) for i, t in enumerate(random_texts(4, seed=2))] + [(9, "".join(random_texts(60, seed=3)))]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.remove_repeats(edge_docs(spark, rows)).collect()}
    assert got == brute_repeats([(i, t.encode()) for i, t in rows])


def test_repeats_edge_rows(spark):
    texts = [r for r in edge_texts() if r[0] not in (8, 10)] + [(8, "word " * 3000)]
    rows = suffix_dedup.remove_repeats(edge_docs(spark, texts)).collect()
    assert len(rows) == len(texts)
    # equal rows are one document; a null id comes last
    distinct = sorted({(i, t or "") for i, t in texts}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = brute_repeats([(k, k[1].encode()) for k in distinct])
    assert sorted(map(str, ((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows))) == sorted(
        map(str, ((i, *want[(i, t or "")]) for i, t in texts)))
    assert suffix_dedup.remove_repeats(empty_docs(spark)).count() == 0


# ---- toxicity ----

def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in text_queries.op1_toxicity(spark, sf).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in rows.items())
    test = [(rows[i]["score"], y, rows[i]["predicted"]) for i, y in labels.items() if i in rows and rows[i]["held_out"]]
    pos, neg = [s for s, y, _ in test if y], [s for s, y, _ in test if not y]
    auc = np.mean([[(a > b) + 0.5 * (a == b) for b in neg] for a in pos])
    assert auc >= 0.95
    assert np.mean([p == y for _, y, p in test]) >= 0.97


def test_labels_of_held_out_rows_are_not_read(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(labels["doc_id"]), 1 - labels["toxic"]).otherwise(labels["toxic"]))
    a, b = (sorted(map(tuple, toxicity.toxicity_scores(docs, x).collect())) for x in (labels, turned))
    assert [r[:2] for r in a] == [r[:2] for r in b]
    assert np.allclose([r[2] for r in a], [r[2] for r in b], atol=1e-12)


def test_class_models_are_distributions():
    words = ["tree", "trash", "three", "the", "a"]
    counts, types = {}, {}
    for k, w in enumerate(words):
        for g in toxicity.grams_of(w):
            t, o = counts.get(g, (0, 0))
            counts[g] = (t + (k % 2), o + 1)
        for g in {t for g in toxicity.grams_of(w) for t in toxicity.tails_of(g)}:
            types[g] = types.get(g, 0) + 1
    shared = toxicity.SharedBackoff(types)
    logs, weights = toxicity.class_model(counts, shared)
    symbols = {g[-1] for g in counts}
    for h in weights:
        for c in (0, 1):  # all symbols, but for the share of the floor
            total = sum(np.exp(logs[h + x][c]) if h + x in logs else np.exp(weights[h][c]) * shared.probability(h + x) for x in symbols)
            assert 0.5 < total <= 1 + 1e-9
    model = toxicity.Differences(*toxicity.Differences.tables(counts, types))
    assert model.word("trash") > model.word("tree") and model.word("zzz") == pytest.approx(model.histories["^"])


def test_word_difference_against_plain_backoff():
    counts = {"^a": (3, 1), "^ab": (2, 0), "^ab$": (2, 0), "^a$": (0, 3), "^b": (0, 4)}
    model = toxicity.Differences(*toxicity.Differences.tables(counts, {"a": 3, "b": 2, "$": 4, "^a": 2, "^b": 1, "^ab": 1, "ab": 1, "b$": 1, "a$": 1, "ab$": 1, "^ab$": 1, "^a$": 1}))
    assert model.word("ab") == pytest.approx(sum(model.grams[g] for g in ("^a", "^ab", "^ab$")))
    assert model.word("abc") == pytest.approx(model.grams["^a"] + model.grams["^ab"] + model.histories["^ab"])
    assert model.word("c") == pytest.approx(model.histories["^"])


@pytest.mark.parametrize("order", [toxicity.ORDER, 12])
def test_fitted_tables_leave_no_n_gram_out(spark, monkeypatch, order):
    monkeypatch.setattr(toxicity, "ORDER", order)
    monkeypatch.setattr(toxicity, "GROUP_WORDS", 30)
    texts = [*random_texts(40, seed=4), "once extraordinarily", "twice twice banana", ""]
    docs = spark.createDataFrame([(t, int(i % 3 == 0), i) for i, t in enumerate(texts)], "text string, toxic int, place int").repartition(3)
    counts, types = {}, {}
    for i, t in enumerate(texts[:20] + texts[40:]):
        for g in (g for w in toxicity.words_of(t) for g in toxicity.grams_of(w)):
            c = counts.setdefault(g, [0, 0])
            c[0 if (i if i < 20 else i + 20) % 3 == 0 else 1] += 1
    for w in {w for t in texts for w in toxicity.words_of(t)}:
        s = f"^{w}$"
        for g in (s[i:j] for i in range(len(s)) for j in range(max(i, 1) + 1, min(i + toxicity.ORDER, len(s)) + 1)):
            types[g] = types.get(g, 0) + 1
    labelled = docs.where(docs["text"].isin(texts[:20] + texts[40:]))
    model = toxicity.HashedDifferences(*toxicity.fitted_tables(labelled, docs))
    plain = toxicity.Differences(*toxicity.Differences.tables({g: tuple(c) for g, c in counts.items()}, types))
    assert any(sum(c) == 1 for c in counts.values()) and len(model.grams[0]) == len(plain.grams) and len(model.histories[0]) == len(plain.histories)
    for w in sorted({w for t in texts for w in toxicity.words_of(t)} | {"zzz", "onceabc"}):
        assert model.word(w) == pytest.approx(plain.word(w), abs=1e-9), w


def test_a_sample_of_too_many_characters_is_halved(spark, monkeypatch):
    rows = [(" ".join(f"word{'abcdefgh'[i]}{'xyz'[j]}" for j in range(3)), i % 2, i) for i in range(8)]
    train = spark.createDataFrame(rows, "text string, toxic int, place int")
    assert len(toxicity.sampled_words(train)[0]) == 24
    monkeypatch.setattr(toxicity, "MAX_WORD_CHARS", 80)
    words, each = toxicity.sampled_words(train)
    assert len(words) == 12 and each.sum() == 12


def test_toxicity_edge_rows(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(i, i % 2, 1, "x") for i in range(1, 40)] + [(None, 1, 1, "x"), (5, None, 1, "x"), (5, 1, 1, "x")], "doc_id long, toxic int, score int, text string")
    rows = toxicity.toxicity_scores(docs, labels).collect()
    assert len(rows) == len(edge_texts()) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert {r["score"] for r in toxicity.toxicity_scores(docs, labels.where("toxic = 1")).collect()} == {1.0}
    assert {r["score"] for r in toxicity.toxicity_scores(docs, labels.where("false")).collect()} == {0.0}
    assert toxicity.toxicity_scores(empty_docs(spark), labels).count() == 0


# ---- pipeline ----

def test_stages_against_their_operators(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "SimHash near-dedup", "benchmark decontamination", "PII", "SentencePiece encoding and decoding"]
    sizes = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
        sizes.append(docs.count())
        if name == "SimHash near-dedup":
            rows = simhash.simhash_components(before).collect()
            assert {r["doc_id"] for r in docs.collect()} == {r["component_id"] for r in rows} and sizes[-1] == len({r["component_id"] for r in rows})
        if name == "PII":
            left = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert not any(re.search(r"[a-z]@mail", t) for t in left.values() if t) and docs.where("n_chars <> length(text)").count() == 0
            texts = left
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4] == sizes[5] > 0.5 * sizes[0]
    for r in docs.collect():
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest() and r["n_tokens"] == len(r["ids"])


def test_stages_take_edge_rows(spark, sf_small, tmp_path):
    for k, rows in enumerate((edge_docs(spark), empty_docs(spark))):
        docs = rows
        for j, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{k}-{j}")
            stage(spark, docs, sf_small).write.parquet(path)
            before, docs = docs, spark.read.schema(stage(spark, docs, sf_small).schema).parquet(path)
            assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == before.columns


def test_stages_give_edge_rows_their_results(spark, sf_small):
    docs, rows = edge_docs(spark), edge_texts()
    stage = dict(corpus_pipeline.STAGES)

    def ids(name, of=docs):
        return sorted((r["doc_id"] for r in stage[name](spark, of, sf_small).collect()), key=lambda i: (i is None, i or 0))

    kept = ids("quality rules")
    assert kept and not {1, 2, 3, 4, 8, 9} & set(kept)  # null, empty, blank, one word, a word over and over, no words
    assert kept.count(6) in (0, 2) and (5 in kept) == (6 in kept) == (20 in kept)  # repeated rows stay or go together
    alone = ids("SimHash near-dedup")
    assert 1 in alone and 5 in alone and not {2, 3, 6, 20, None} & set(alone)  # the smallest id of null, empty and blank texts, and of equal ones
    assert len(alone) == len(set(alone)) + 1 and alone.count(10) == 2  # two texts of one id
    assert len(ids("benchmark decontamination")) == len(rows)
    masked = stage["PII"](spark, docs, sf_small).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in masked), key=repr) == sorted(rows, key=repr)  # none of them holds personal data
    coded = stage["SentencePiece encoding and decoding"](spark, docs, sf_small).collect()
    assert sorted(r["n_tokens"] for r in coded if r["doc_id"] in (1, 2)) == [1, 1] and len(coded) == len(rows)


def test_run_equals_the_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_small)
    assert sorted(map(str, docs.collect())) == sorted(map(str, corpus_pipeline.run(spark, sf_small).collect()))


def test_only_counts_of_the_samples_strings_come_to_the_driver(spark):
    sample, corpus = ["abcab", "zug", "é"], ["abcab", "abcdefgh", "zug", "zugabe", "é", "qqqq"]
    grams = toxicity.SampleGrams(sample)
    counts = toxicity.corpus_counts(spark.createDataFrame([(w,) for w in corpus], "word string"), grams)
    marked = [f"^{w}$" for w in sample]
    wanted = {w[a:b] for w in marked for a in range(len(w)) for b in range(a + 1, min(len(w), a + toxicity.ORDER) + 1)}
    keys = {}
    for g in wanted | {c for w in corpus for c in w}:
        key = int(toxicity.EMPTY)
        for c in g:
            key = toxicity._longer_key(key, c)
        keys[key] = g
    assert {keys[int(k)] for k in grams.keys} == wanted
    # nothing but the sample's strings and single characters
    got = {keys[int(k)]: n for k, n in zip(*counts["gram"], strict=True)}
    assert all(n == sum(f"^{w}$".startswith(g, i) for w in corpus for i in range(len(w) + 2)) for g, n in got.items())
    assert {g for g in wanted if g != "^"} == {g for g in got if len(g) > 1 or g in wanted}
    for (kinds, history, ending), shorter in zip(grams.levels, [np.array([toxicity.EMPTY])] + [level[0] for level in grams.levels], strict=False):
        for key, h, e in zip(kinds, history, ending, strict=True):
            g = keys[int(key)]
            assert (keys.get(int(shorter[h]), ""), keys.get(int(shorter[e]), "")) == (g[:-1], g[1:])


def gram_key(gram):
    key = int(toxicity.EMPTY)
    for c in gram:
        key = toxicity._longer_key(key, c)
    return key


def in_arrays(values):
    found = sorted((gram_key(g), x) for g, x in values.items())
    return np.array([k for k, _ in found], dtype=np.uint64), np.array([x for _, x in found])


def test_words_between_any_characters():
    rnd = random.Random(3)
    some = "aZ09_ .-\n\t\0éßÀİſ漢字²½٣ⅷªº‿’—　 ́𝒜𐐀😀"
    texts = ["".join(rnd.choice(some) for _ in range(rnd.randint(0, 30))) for _ in range(3000)] + ["".join(map(chr, range(a, a + 64))) for a in range(0, 0x3000, 64)]
    for t in [None, "", *texts]:
        assert toxicity.words_of(t) == toxicity._WORD.findall((t or "").lower()), t


def test_keys_are_found_by_their_leading_bits():
    rnd = np.random.default_rng(1)
    top = ~np.uint64(0)
    for held in ([], [0], [top], [5, 6, 7, 8, top], rnd.integers(0, top, 5000, dtype=np.uint64), np.append(rnd.integers(0, 300, 200, dtype=np.uint64), top)):
        held = np.unique(np.array(held, dtype=np.uint64))
        asked = np.concatenate((held, held + np.uint64(1), held - np.uint64(1), rnd.integers(0, top, 500, dtype=np.uint64), np.array([0, top], dtype=np.uint64)))
        places = {int(k): i for i, k in enumerate(held)}
        assert toxicity.Keys(held).find(asked).tolist() == [places.get(int(k), -1) for k in asked]


@pytest.mark.parametrize("group, cache", [(50_000, 200_000), (50_000, 40), (7, 40), (1, 200_000)])
def test_texts_scored_together_score_as_alone(monkeypatch, group, cache):
    texts = [*random_texts(60, seed=6), "", None, "one", "one one one", "a b c d e f g", "b " * 20, "a b " * 9, "0 9 .", "é 漢字 and so on and on " * 40, "x" * 3000]
    counts, types = {}, {}
    for i, w in enumerate(w for t in texts[:30] for w in toxicity.words_of(t)):
        for g in toxicity.grams_of(w):
            counts[g] = tuple(n + (c == i % 3 > 0) for c, n in enumerate(counts.get(g, (0, 1))))
            types |= {x: types.get(x, 0) + 1 for x in toxicity.tails_of(g)}
    plain = toxicity.Differences(*toxicity.Differences.tables(counts, types))
    monkeypatch.setattr(toxicity, "GROUP_WORDS", group)
    monkeypatch.setattr(toxicity, "CACHE_WORDS", cache)
    model, asked = toxicity.HashedDifferences(in_arrays(plain.grams), in_arrays(plain.histories)), []
    real = model.of_lists
    monkeypatch.setattr(model, "of_lists", lambda lists: asked.append(len(lists)) or real(lists))
    got = model.of_texts(texts)
    assert np.allclose(got, [plain.features(t) for t in texts], atol=1e-9) and np.abs(got).max() > 0.1
    assert sum(asked) == len(texts) and (len(asked) == 1 if group == 50_000 else len(asked) > 50)  # not text by text
    assert model.of_texts([None, "", "1 2"]).tolist() == [[0.0] * 3] * 3 and model.of_texts([]).shape == (0, 3)


@pytest.mark.parametrize("group", [1, 2, 5, 1000])
def test_endings_counted_in_groups_of_any_size(monkeypatch, group):
    rnd = random.Random(7)
    endings = sorted("^" * rnd.randint(0, 1) + "".join(rnd.choice("abé漢") for _ in range(rnd.randint(1, 6))) + "$" * rnd.randint(0, 1) for _ in range(300)) + ["é", "漢$"]
    endings.sort(key=str.encode)
    asked = {e[:n] for e in endings[::3] for n in range(1, len(e) + 1)}
    want = {}
    for size in range(1, 9):
        for g in {e[:size] for e in endings if len(e) >= size}:
            times = sum(e.startswith(g) for e in endings)
            if g != "^" and (size == 1 or g in asked):
                want[0 if size > 1 else 2, g] = (2 * times, 0)
            after = [e[size] for e in endings if e.startswith(g) and len(e) > size]
            if after and g in asked:
                want[1, g] = (2 * len(after), len(set(after)))
    monkeypatch.setattr(toxicity, "GROUP_WORDS", group)
    batches = [pa.RecordBatch.from_pydict({"ending": endings[a : a + 7], "n": [2] * len(endings[a : a + 7])}) for a in range(0, len(endings), 7)]
    names, got = {gram_key(e[:n]): e[:n] for e in endings for n in range(1, len(e) + 1)}, {}
    for batch in toxicity._trie_counts(iter(batches), toxicity.Keys(np.unique(np.array([gram_key(g) for g in asked], dtype=np.uint64)))):
        for r in batch.to_pylist():
            at = r["kind"], names[r["key"] % 2**64]
            got[at] = tuple(a + b for a, b in zip(got.get(at, (0, 0)), (r["n"], r["others"])))
    assert got == want
