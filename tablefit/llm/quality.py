"""Quality rules as weak supervision: rules vote or abstain, EM estimates how each votes on good and on bad texts."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablefit.llm.common import UPPER, map_text, quoted, written

BAD, ABSTAIN, GOOD = 0, 1, 2
WINDOW = 8
NO_LETTER = re.compile(rb"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+").fullmatch
SYMBOLS = [b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"]
SPACES = [b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"]
UPPER_BYTES = UPPER.encode()
SENTENCE_ENDS = [b". ", b".\n", b"? ", b"?\n", b"! ", b"!\n"]
#: Fixed values of the base rules.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A text is kept from this posterior probability of good quality on.
KEEP_FROM = 0.5
#: Where EM starts, for bad texts and for good ones: P(bad vote), P(good vote where the vote is not bad) of a rule that votes either way, and the share
#: of good texts.  Alarms are rare on any junk, as each knows one kind of it, and hardly ever ring on good texts; so a text with one alarm and
#: nothing else against it is more likely bad.
START_BAD_VOTE = np.array([0.15, 0.001])
START_GOOD_VOTE = np.array([0.75, 0.95])
START_GOOD = 0.9
#: Weight of that start against all texts, and of the bad votes on good texts: that an alarm hardly ever rings there is what the rule was written for, and
#: weighs as much as all texts.
PRIOR_SHARE = 0.05
FALSE_ALARM_SHARE = 1.0

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Votes bad from ``bad`` on, good up to ``good``, else abstains (thresholds of a measure that rises with junk)."""

    name: str
    bad: float
    good: float


NEVER = float("-inf")
#: Each measure is a share, most of them of the words.  Alarms only vote bad; the last three vote either way.
RULES = (
    Rule("too_short", 0.7, NEVER),         # 20 / (20 + words): 0.7 is 8 words
    Rule("word_length", 1.0, NEVER),       # distance of the mean word length from 6 characters, over 6
    Rule("symbols", 0.10, NEVER),
    Rule("duplicate_lines", 0.60, NEVER),  # of the lines
    Rule("repeated_windows", 0.30, NEVER),
    Rule("same_neighbours", 0.10, NEVER),  # words equal to the word before
    Rule("upper_case", 0.40, NEVER),       # A-Z of the characters in words
    Rule("exclamations", 0.10, NEVER),
    Rule("wordless", 0.10, 0.005),         # words without letter or digit
    Rule("no_sentences", 0.995, 0.96),     # words that no sentence end follows, but for one
    Rule("few_distinct", 0.95, 0.60),      # words that occurred before, over n^(1/4) as long texts repeat more
)
N_PATTERNS = 3 ** len(RULES)
#: Odd multiplier of the rolling sums that rule out repeated windows.
MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_window_words(ids: np.ndarray, kinds: int, width: int = WINDOW) -> int:
    """Words inside a window of ``width`` (a power of two) words that is found twice or more, the first one included.

    ``ids`` names the words by numbers below ``kinds``.  Without two equal rolling sums there are no equal windows;
    otherwise windows are named exactly, by pairs of the names of their halves.
    """
    n = len(ids) - width + 1
    if n < 2 or kinds == len(ids):
        return 0
    sums = np.zeros(n, dtype=np.uint64)
    wide = ids.astype(np.uint64) + np.uint64(1)
    for j in range(width):
        sums = sums * MIX + wide[j : j + n]
    sums.sort()
    if not (sums[1:] == sums[:-1]).any():
        return 0
    cur, step, size = ids, 1, kinds
    while step < width:
        names, cur = np.unique(cur[:-step] * size + cur[step:], return_inverse=True)
        step, size = 2 * step, len(names)
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    starts = np.flatnonzero(np.bincount(cur)[cur] > 1)
    edge[starts] += 1
    edge[starts + width] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_stats(text: str) -> tuple[tuple[int, ...], list[float]]:
    """The counts of STATS and the measures of RULES."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes: ASCII white space only
    n = len(words)
    some = max(n, 1)
    word_chars = len(text) - sum(map(raw.count, SPACES))
    symbols = sum(map(raw.count, SYMBOLS))
    lines = raw.split(b"\n")
    if len(lines) > 1:
        lines = [x for x in lines if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    names: dict[bytes, int] = {}
    ids = np.fromiter([names.setdefault(w, len(names)) for w in words], dtype=np.int64, count=n)
    repeat = repeated_window_words(ids, len(names))
    bare = [i for w, i in names.items() if NO_LETTER(w)]
    measures = [
        20 / (20 + n),
        abs(word_chars / some - 6) / 6,
        symbols / some,
        dup_lines / max(len(lines), 1),
        repeat / some,
        int((ids[1:] == ids[:-1]).sum()) / some,
        (len(raw) - len(raw.translate(None, UPPER_BYTES))) / max(word_chars, 1),
        raw.count(b"!") / some,
        int(np.isin(ids, bare).sum()) / some if bare else 0.0,
        1 - (1 + sum(map(raw.count, SENTENCE_ENDS))) / some,
        (1 - len(names) / some) / max(1.0, some / 100) ** 0.25,
    ]
    return (n, word_chars, symbols, dup_lines, repeat), measures


def pattern_of(measures: list[float]) -> int:
    """All votes as one number in base 3."""
    code = 0
    for rule, x in zip(RULES, measures, strict=True):
        code = 3 * code + (BAD if x >= rule.bad else GOOD if x <= rule.good else ABSTAIN)
    return code


def votes_of(code: int) -> list[int]:
    return [code // 3 ** (len(RULES) - 1 - i) % 3 for i in range(len(RULES))]


def quality_stats(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default), the counts of STATS, and ``votes``: the rules' votes as one number."""
    added = T.StructType([*[T.StructField(n, T.LongType()) for n in STATS], T.StructField("votes", T.LongType())])

    def make():
        def fn(texts):
            found = [text_stats(t or "") for t in texts]
            counts = [pa.array([s[i] for s, _ in found], pa.int64()) for i in range(len(STATS))]
            return [*counts, pa.array([pattern_of(m) for _, m in found], pa.int64())]

        return fn

    return map_text(docs, text_col, added, make, carry)


@dataclass(frozen=True)
class LabelModel:
    """``posterior``: probability of good quality by vote pattern; ``objective``: log-likelihood a text, with the prior's, before each round and at the end."""

    posterior: dict[int, float]
    objective: list[float]


def fit_label_model(patterns: dict[int, int], rounds: int = 500) -> LabelModel:
    """The label model from the number of texts with each vote pattern.

    Two classes; within a class a rule votes bad, abstains or votes good independently of the others, with probabilities that sum to one (alarms never vote
    good).  EM estimates them and the share of good texts.  The starting values also are a prior with PRIOR_SHARE of all texts' weight
    (FALSE_ALARM_SHARE for bad votes on good texts), so that a few texts turn no rule round; a rule's bad votes may not be likelier on good texts than on bad ones, nor its good votes on bad
    texts: where they would, both classes get the pooled value, which is the best one under that order.  So no round lowers the objective.
    """
    if not patterns:
        return LabelModel({}, [])
    codes = sorted(patterns)
    votes = np.array([votes_of(c) for c in codes])
    weight = np.array([patterns[c] for c in codes], dtype=float)
    weight /= weight.sum()
    either = np.array([r.good != NEVER for r in RULES])
    class_prior = PRIOR_SHARE * np.array([1 - START_GOOD, START_GOOD])
    alarm_prior = np.array([class_prior[0], FALSE_ALARM_SHARE])
    bad = np.repeat(START_BAD_VOTE[:, None], len(RULES), axis=1)
    good = np.repeat(START_GOOD_VOTE[:, None], len(RULES), axis=1)
    share = START_GOOD
    history: list[float] = []
    for last in range(rounds + 1):
        logs = _class_logs(votes, bad, good, either) + np.log([1 - share, share])[:, None]
        whole = np.logaddexp(*logs)
        post = np.exp(logs[1] - whole)
        prior = (class_prior * np.log([1 - share, share])).sum()
        for value, start, own in ((bad, START_BAD_VOTE, alarm_prior), (good[:, either], START_GOOD_VOTE, class_prior)):
            prior += (own[:, None] * (start[:, None] * np.log(value) + (1 - start[:, None]) * np.log(1 - value))).sum()
        history.append(float(weight @ whole + prior))
        if last == rounds or len(history) > 1 and history[-1] - history[-2] < 1e-12:
            break
        mass = np.stack([(1 - post) * weight, post * weight])
        share = float(mass[1].sum() + class_prior[1]) / (1 + PRIOR_SHARE)
        bad = _ordered(mass @ (votes == BAD), mass.sum(axis=1)[:, None], START_BAD_VOTE, alarm_prior, larger=0)
        good = _ordered(mass @ (votes == GOOD), mass @ (votes != BAD), START_GOOD_VOTE, class_prior, larger=1)
    return LabelModel(dict(zip(codes, post.tolist(), strict=True)), history)


def _ordered(hits: np.ndarray, of: np.ndarray, start: np.ndarray, weight: np.ndarray, larger: int) -> np.ndarray:
    """Shares of hits by class, the start added with its weight; pooled where they are not larger for that class."""
    hits, of = hits + (weight * start)[:, None], of + weight[:, None] + np.zeros_like(hits)
    share = hits / of
    wrong = share[larger] < share[1 - larger]
    share[:, wrong] = (hits.sum(axis=0) / of.sum(axis=0))[wrong]
    return share


def _class_logs(votes: np.ndarray, bad: np.ndarray, good: np.ndarray, either: np.ndarray) -> np.ndarray:
    """Log-probability of each pattern in each class."""
    rest = np.log(1 - bad)
    voted = np.stack([np.log(bad), rest + np.where(either, np.log(1 - good), 0.0), rest + np.where(either, np.log(good), 0.0)], axis=2)
    return np.stack([table[np.arange(votes.shape[1]), votes].sum(axis=1) for table in voted])


def quality_rules(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default), the counts of STATS, ``base_failed``, ``quality`` and ``kept``.

    ``quality``: posterior probability of good quality given all votes.  ``kept``: false where a base rule fails, else
    quality >= KEEP_FROM.  The label model is fitted on the number of texts with each of at most 3^rules vote patterns, counted
    over all rows; votes and carried columns are written to the shared folder meanwhile, so each text is read once.  Null and empty texts have no
    words and fail; texts of any length are judged whole; repeated rows count as often as they occur; equal votes get equal verdicts; carried
    columns with the name of a result give way to it; an empty table gives no rows.
    """
    kept = [c for c in (docs.columns if carry is None else carry) if c not in (*STATS, "votes", "quality", "base_failed", "kept")]
    stats = written(quality_stats(docs, text_col, kept), "quality")
    counted = stats.groupBy("votes").count()
    posterior = fit_label_model({r["votes"]: r["count"] for r in counted.collect()}).posterior  # N_PATTERNS rows at most
    model = docs.sparkSession.createDataFrame(sorted(posterior.items()), "votes long, quality double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        stats.join(F.broadcast(model), "votes", "left").withColumn("base_failed", failed)
        .select(*[quoted(c) for c in kept], *STATS, "votes", "quality", "base_failed",
                (~F.col("base_failed") & (F.coalesce("quality", F.lit(0.0)) >= KEEP_FROM)).alias("kept"))
    )
