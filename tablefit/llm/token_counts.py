"""Token counts under a unigram reading of a piece vocabulary, by dynamic programming over a shared trie.

The segmentation of a pre-token is the one with the highest sum of piece scores (fewest tokens among equals); a character that is no
piece costs UNKNOWN below the lowest score and counts one token for each of its UTF-8 bytes.  The distinct pre-tokens of a batch
form a trie; walking it in order, the forward score of each shared prefix is computed once.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablefit.llm.common import in_worker, map_text
from tablefit.llm.pieces import Pieces, chunks, shared_model

UNKNOWN = 10.0
#: Terminal counts kept in each worker, and the longest pre-token kept.
CACHE_TOKENS = 300_000
CACHE_CHARS = 64


class TrieCounter:
    def __init__(self, model: bytes) -> None:
        pieces = Pieces(model)
        self.scores = pieces.scores
        self.longest = max(map(len, self.scores))
        self.unknown = min(self.scores.values()) - UNKNOWN
        self.counts: dict[str, int] = {}

    def learn(self, words: set[str]) -> None:
        """Terminal counts of new pre-tokens; the path of the trie that leads to the current one is held as two lists."""
        scores, longest = self.scores, self.longest
        get = scores.get
        best: list[float] = [0.0]
        tokens: list[int] = [0]
        path = ""
        for word in sorted(words):
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del best[shared + 1 :], tokens[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                char = word[end - 1]
                if char in scores:
                    top, count = float("-inf"), 0
                    for start in range(max(0, end - longest), end):
                        if (s := get(word[start:end])) is not None:
                            s += best[start]
                            if s > top or s == top and tokens[start] + 1 < count:
                                top, count = s, tokens[start] + 1
                else:
                    top, count = best[end - 1] + self.unknown, tokens[end - 1] + len(char.encode("utf-8", "replace"))
                best.append(top)
                tokens.append(count)
            self.counts[word] = tokens[-1]
            path = word

    def count(self, texts: list[str]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        if len(self.counts) > CACHE_TOKENS:
            self.counts.clear()
        cut = [chunks(t) for t in texts]
        self.learn({c for cs in cut for c in cs}.difference(self.counts))
        get = self.counts.__getitem__
        out = [(len(cs), sum(map(get, cs))) for cs in cut]
        for c in [c for cs in cut for c in cs if len(c) > CACHE_CHARS]:
            self.counts.pop(c, None)
        return out


COUNTS = T.StructType([T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())])


def token_counts(docs: DataFrame, model_path: str, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default), ``n_pretokens`` and ``n_tokens`` of each whole text.

    Null and empty texts have none; repeated rows stay repeated; carried columns with the name of a result give way to it; an empty
    table gives no rows.
    """
    model = shared_model(docs.sparkSession, model_path)

    def make():
        counter = in_worker(model, TrieCounter)

        def fn(texts):
            found = counter.count([t or "" for t in texts])
            return [pa.array([n for n, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())]

        return fn

    return map_text(docs, text_col, COUNTS, make, carry)
