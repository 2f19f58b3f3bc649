"""Quality rules, decontamination, SentencePiece and token counts: brute force, the library, oracles, edge rows."""

import itertools
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import sentencepiece

from tablefit.llm import decontaminate, quality, text_queries
from tablefit.llm.pieces import chunks
from tablefit.llm.sentencepiece_codec import Encoder, encode_documents
from tablefit.llm.token_counts import TrieCounter, token_counts
from tests.llm.helpers import edge_docs, edge_texts, empty_docs, random_texts
from tools.check_oracle import compare

WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def model():
    with open(text_queries.piece_model(), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


# ---- quality ----

def brute_stats(text):
    words = re.findall(WORD, text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            hit.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_stats_against_brute_force():
    rnd = random.Random(4)
    few = ["".join(rnd.choice("ab \n|#é\x0b") for _ in range(rnd.randint(0, 150))) for _ in range(300)]
    for text in [*few, *random_texts(30), "a b c d e f g h a b c d e f g h i", "x " * 5000, "", "\n\n a\n a\n a"]:
        assert quality.text_stats(text)[0] == brute_stats(text)


def test_quality_query_against_labels(spark, sf_small):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = text_queries.op7_quality_rules(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    right = 0
    for r in rows:
        stats = brute_stats(docs[r["doc_id"]])
        assert tuple(r[c] for c in quality.STATS) == stats
        failed = stats[0] < 20 or 100 * stats[4] > 30 * stats[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
        if not failed and r["doc_id"] in labels:
            right += r["kept"] == bool(labels[r["doc_id"]])
    judged = sum(not r["base_failed"] and r["doc_id"] in labels for r in rows)
    assert right >= 0.97 * judged


def vote_code(**votes):
    """A pattern in which the rules named vote as given, the two-way rules good and the alarms not at all otherwise."""
    code = 0
    for r in quality.RULES:
        code = 3 * code + votes.get(r.name, quality.ABSTAIN if r.good == quality.NEVER else quality.GOOD)
    return code


def test_label_model_keeps_what_no_rule_alarms():
    clean, alarmed = vote_code(), vote_code(symbols=quality.BAD)
    for n, m in ((1000, 40), (1000, 400), (10, 1)):
        model = quality.fit_label_model({clean: n, alarmed: m})
        assert model.posterior[clean] > 0.9 > 0.5 > model.posterior[alarmed]
    assert quality.fit_label_model({}).posterior == {}
    only = quality.fit_label_model({clean: 5})
    assert only.posterior[clean] > 0.9


def test_label_model_never_lowers_its_objective():
    rnd = random.Random(8)
    rules = [r.name for r in quality.RULES]
    for _ in range(20):
        patterns = Counter()
        for _ in range(rnd.randint(1, 40)):
            named = {n: rnd.choice([quality.BAD, quality.ABSTAIN] + [quality.GOOD] * (quality.RULES[rules.index(n)].good != quality.NEVER)) for n in rnd.sample(rules, 4)}
            patterns[vote_code(**named)] += rnd.randint(1, 500)
        got = quality.fit_label_model(dict(patterns))
        assert all(b >= a - 1e-12 for a, b in itertools.pairwise(got.objective))
        assert all(0 <= p <= 1 for p in got.posterior.values())


def test_label_model_against_a_plain_em():
    """The same rounds with plain sums, pattern by pattern."""
    patterns = {vote_code(): 300, vote_code(symbols=quality.BAD): 30, vote_code(symbols=quality.BAD, wordless=quality.BAD): 20, vote_code(few_distinct=quality.ABSTAIN): 9,
                vote_code(upper_case=quality.BAD, no_sentences=quality.ABSTAIN): 4}
    total, rules = sum(patterns.values()), range(len(quality.RULES))
    either = [r.good != quality.NEVER for r in quality.RULES]
    weak = [quality.PRIOR_SHARE * (1 - quality.START_GOOD), quality.PRIOR_SHARE * quality.START_GOOD]
    strong = [weak[0], quality.FALSE_ALARM_SHARE]
    p_bad = [[float(quality.START_BAD_VOTE[c])] * len(rules) for c in (0, 1)]
    p_good = [[float(quality.START_GOOD_VOTE[c])] * len(rules) for c in (0, 1)]
    share = quality.START_GOOD

    def posterior(code):
        like = [1 - share, share]
        for r, v in enumerate(quality.votes_of(code)):
            for c in (0, 1):
                if v == quality.BAD:
                    like[c] *= p_bad[c][r]
                else:
                    like[c] *= (1 - p_bad[c][r]) * ((p_good[c][r] if v == quality.GOOD else 1 - p_good[c][r]) if either[r] else 1)
        return like[1] / sum(like)

    rounds = 7
    for _ in range(rounds):
        mass = {code: [n / total * (1 - posterior(code)), n / total * posterior(code)] for code, n in patterns.items()}
        size = [sum(m[c] for m in mass.values()) for c in (0, 1)]
        share = (size[1] + weak[1]) / (1 + quality.PRIOR_SHARE)
        for r in rules:
            bad, good = [], []
            for c in (0, 1):
                hit = {v: sum(m[c] for code, m in mass.items() if quality.votes_of(code)[r] == v) for v in (quality.BAD, quality.GOOD)}
                bad.append((hit[quality.BAD] + strong[c] * quality.START_BAD_VOTE[c], size[c] + strong[c]))
                good.append((hit[quality.GOOD] + weak[c] * quality.START_GOOD_VOTE[c], size[c] - hit[quality.BAD] + weak[c]))
            for table, parts, larger in ((p_bad, bad, 0), (p_good, good, 1)):
                found = [a / b for a, b in parts]
                if found[larger] < found[1 - larger]:
                    found = [sum(a for a, _ in parts) / sum(b for _, b in parts)] * 2
                table[0][r], table[1][r] = found
    got = quality.fit_label_model(patterns, rounds).posterior
    assert all(abs(got[code] - posterior(code)) < 1e-9 for code in patterns)


def test_quality_edge_rows(spark):
    rows = quality.quality_rules(edge_docs(spark)).collect()
    assert len(rows) == len(edge_texts())
    assert all(not r["kept"] for r in rows if not (r["text"] or "").strip())
    assert quality.quality_rules(empty_docs(spark)).count() == 0


# ---- decontamination ----

def brute_contamination(text, items):
    def words(t):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    ws, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        n = min(13, len(iw))
        wins = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(ws) - n + 1):
            if tuple(ws[i : i + n]) in wins:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(ws), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(ws)


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 60])
def test_contamination_against_brute_force(spark, block_words):
    texts = random_texts(12, seed=9)
    items = [(1, texts[0]), (2, "abc"), (3, ""), (4, None), (None, texts[3]), (10, texts[1].upper()), (10, texts[1].upper()), (2, texts[2] + " x"), (11, "é ß")]
    rows = [*edge_texts(), (90, texts[0] + "!!" + texts[1]), (91, "xx " * 300 + texts[2]), (92, "ABC-abc"), (93, "É é ß")]
    benchmark = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, items string")
    got = decontaminate.find_contamination(edge_docs(spark, rows), benchmark, block_words=block_words).collect()
    want = [brute_contamination(t, [x for x in items if x[0] is not None]) for _, t in rows]
    key = [(i, t) for i, t in rows]
    assert sorted(map(str, ((r["doc_id"], r["text"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got))) == sorted(
        map(str, ((*k, w[0], w[1], w[2], w[3]) for k, w in zip(key, want, strict=True))))


def test_contamination_of_empty_tables(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontaminate.find_contamination(edge_docs(spark), benchmark).collect())
    assert decontaminate.find_contamination(empty_docs(spark), benchmark).count() == 0


def test_contamination_query_matches_sql(spark, sf_small):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    assert compare(text_queries.op6_decontaminate(spark, sf_small).toPandas(), con.execute(text_queries.OP6_SQL).df()) == "OK"


# ---- SentencePiece ----

def test_encoding_equals_the_library(model, library, sf_small):
    rnd = random.Random(7)
    texts = [" " * n + s for n in range(40) for s in ("", "the", "\n", "zq", "é", "漢字", "x\n ", "▁", "a" + " " * n + "b")]
    texts += ["".join(rnd.choice(al) for _ in range(rnd.randint(0, 120))) for al in ("thernoisa ", "abc  \n\t▁éü漢😀.,019A", "ab") for _ in range(400)]
    texts += [t or "" for _, t in edge_texts()] + ["</s><s><unk><0x41>", "\x00\x00a", "a" * 3000, "\ufeffx", "\r\n"]
    encoder = Encoder(model)
    for t in texts:
        want = library.encode(t)
        n_ids, joined, decoded = encoder.round_trip(t)
        assert n_ids == len(want) and encoder.encode(t) == want and joined == " ".join(map(str, want))
        assert decoded == library.decode(want) == encoder.decode(want)


def test_encode_query_equals_the_library(spark, sf_small, library):
    import hashlib

    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()}
    for r in text_queries.op2_sentencepiece(spark, sf_small).collect():
        ids = library.encode(docs[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_encode_edge_rows(spark, library):
    rows = encode_documents(edge_docs(spark), text_queries.piece_model()).collect()
    assert len(rows) == len(edge_texts())
    assert all(r["ids"] == library.encode(r["text"] or "", add_eos=True) and r["n_tokens"] == len(r["ids"]) for r in rows)
    assert encode_documents(empty_docs(spark), text_queries.piece_model()).count() == 0


# ---- token counts ----

def brute_count(counter, word):
    best = (float("-inf"), 0)
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts = [word[a:b] for a, b in itertools.pairwise([0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)])]
        score, tokens = 0.0, 0
        for p in parts:
            if p in counter.scores:
                score, tokens = score + counter.scores[p], tokens + 1
            elif len(p) == 1:
                score, tokens = score + counter.unknown, tokens + len(p.encode())
            else:
                break
        else:
            best = max(best, (score, -tokens))
    return -best[1]


def test_trie_counts_against_brute_force(model):
    counter = TrieCounter(model)
    rnd = random.Random(3)
    words = {"▁" + "".join(rnd.choice("thernoisaé\n😀▁ ") for _ in range(rnd.randint(0, 9))) for _ in range(150)} | {"▁the", "▁then", "▁theory", "a"}
    counter.learn(words)
    assert {w: counter.counts[w] for w in words} == {w: brute_count(counter, w) for w in words}


def test_trie_counts_equal_a_unigram_model(model, library, sf_small, spark):
    from tokenizers import Tokenizer, models

    unigram = Tokenizer(models.Unigram([(library.id_to_piece(i), library.get_score(i)) for i in range(library.get_piece_size())], 0, True))
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").limit(25).collect()}
    got = {r["doc_id"]: r for r in text_queries.op5_token_counts(spark, sf_small).collect()}
    assert len(got) == 200
    for i, t in docs.items():
        cut = chunks(t)
        assert got[i]["n_pretokens"] == len(cut)
        assert got[i]["n_tokens"] == sum(len(unigram.encode(c).ids) for c in cut)


def test_token_count_edge_rows(spark):
    rows = token_counts(edge_docs(spark), text_queries.piece_model()).collect()
    assert len(rows) == len(edge_texts())
    assert all(r["n_tokens"] == 0 for r in rows if not r["text"])
    assert np.all([r["n_tokens"] > 0 for r in rows if r["text"]])
    assert token_counts(empty_docs(spark), text_queries.piece_model()).count() == 0
