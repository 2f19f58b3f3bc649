"""Exact merge-type encoding by backtracking, and decoding.

The merges of a text end in the one sequence of pieces in which every two neighbours, taken as a text of their own and merged
anew, come out as themselves.  The encoder looks for that sequence from the left: the longest piece at a position
(the longest matches come from one Aho-Corasick pass) is taken if it is compatible with the piece before it; else the next
shorter one that it begins with is tried, and without any, the last piece is taken back and its end marked in a bitfield of failed positions, so that no position
fails twice.

That holds where no two pieces have the same rank.  Runs of spaces do (their pieces share one score): a chunk that begins with two spaces or
more is merged directly, from the left among equals.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablefit.llm.common import in_worker, map_text
from tablefit.llm.pieces import SPACE, Pieces, chunks, shared_model

#: Chunks that a worker keeps with their encoding (twice, latest and older ones), the longest one kept, and the pairs of pieces it remembers.
CACHE_CHUNKS = 300_000
CACHE_CHARS = 40
CACHE_PAIRS = 500_000


def merge(chars: str, scores: dict[str, float]) -> list[str]:
    """Merges of a text: the neighbours whose join has the best score first, the leftmost among equals."""
    parts: list[str] = list(chars)
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(-scores[p], i, p) for i in range(n - 1) if (p := parts[i] + parts[i + 1]) in scores]
    heapq.heapify(heap)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = after[i]
        if not parts[i] or j >= n or parts[i] + parts[j] != joined:
            continue  # a side was merged meanwhile
        parts[i], parts[j] = joined, ""
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (p := joined + parts[k]) in scores:
                heapq.heappush(heap, (-scores[p], i, p))
        if (h := before[i]) >= 0 and (p := parts[h] + joined) in scores:
            heapq.heappush(heap, (-scores[p], h, p))
    return [p for p in parts if p]


class Encoder:
    def __init__(self, model: bytes) -> None:
        self.pieces = Pieces(model)
        self.automaton = ahocorasick.Automaton()
        for p in self.pieces.ids:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        own = {p: p for p in self.pieces.ids}  # one object for each piece, whose hash is worked out once
        #: Of each piece the longest other piece that it begins with.
        self.shorter = {p: q for p in own if (q := next((own[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in own), None))}
        self.id_texts = {p: str(i) for p, i in self.pieces.ids.items()}
        #: By left piece, then right piece.
        self.fits: dict[str, dict[str, bool]] = defaultdict(dict)
        self.n_fits = 0
        #: By chunk without its first space: the ids joined by spaces; with the decoded text beside them where that is another one.
        self.known: dict[str, str | tuple[str, str]] = {}
        self.older: dict[str, str | tuple[str, str]] = {}

    def compatible(self, left: str, right: str) -> bool:
        """Whether both come out as themselves when their join is merged anew (``right`` alone after an empty ``left``)."""
        if self.n_fits >= CACHE_PAIRS:
            for row in self.fits.values():
                row.clear()
            self.n_fits = 0
        self.n_fits += 1
        ok = self.fits[left][right] = merge(left + right, self.pieces.scores) == ([left, right] if left else [right])
        return ok

    def backtrack(self, run: str) -> list[str] | None:
        """Pieces of a run of known characters; None with an unknown one."""
        fits = self.fits
        taken: list[str] = []
        last, row, pos = "", fits[""], 0
        for end, piece in self.automaton.iter_long(run):  # the longest piece at each place where the one before ends
            if end + 1 - len(piece) != pos:
                return None
            ok = row.get(piece)
            if not (self.compatible(last, piece) if ok is None else ok):
                return self._step_back(run, taken, pos, self.shorter.get(piece))
            taken.append(piece)
            last, row, pos = piece, fits[piece], end + 1
        return taken if pos == len(run) else None

    def _step_back(self, run: str, taken: list[str], pos: int, piece: str | None) -> list[str] | None:
        """Goes on from the pieces taken, with the next piece to try at ``pos``: shorter ones in turn, and a step back where none fits."""
        fits, shorter, n = self.fits, self.shorter, len(run)
        failed: bytearray | None = None
        last = taken[-1] if taken else ""
        while True:
            row = fits[last]
            while piece is not None:
                end = pos + len(piece)
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    ok = row.get(piece)
                    if self.compatible(last, piece) if ok is None else ok:
                        break
                piece = shorter.get(piece)
            if piece is None:
                if failed is None:
                    failed = bytearray(n // 8 + 1)
                failed[pos >> 3] |= 1 << (pos & 7)
                piece = taken.pop()
                pos -= len(piece)
                last = taken[-1] if taken else ""
                piece = shorter.get(piece)
                continue
            taken.append(piece)
            last, pos = piece, end
            if pos == n:
                return taken
            end, piece = next(self.automaton.iter_long(run, pos), (-1, ""))
            if end + 1 - len(piece) != pos:
                return None

    def chunk_ids(self, chunk: str) -> list[int]:
        ids, known = self.pieces.ids, self.pieces.byte_ids
        if (taken := self._run(chunk)) is not None:
            return [ids[p] for p in taken]
        out: list[int] = []
        start = 0
        for i, c in enumerate(chunk):
            if c not in ids:  # merges never reach over an unknown character; it becomes its bytes
                out += [ids[p] for p in self._run(chunk[start:i])]
                out += [known[b] for b in c.encode("utf-8", "replace")]
                start = i + 1
        return out + [ids[p] for p in self._run(chunk[start:])]

    def _run(self, run: str) -> list[str] | None:
        if not run.startswith(SPACE * 2):
            return self.backtrack(run)
        return merge(run, self.pieces.scores) if self.pieces.ids.keys() >= set(run) else None

    def decode_chunk(self, ids: list[int]) -> str:
        """Text of ids, spaces kept; runs of byte pieces are read as UTF-8."""
        p = self.pieces
        if p.special.isdisjoint(ids):
            return "".join([p.strings[i] for i in ids]).replace(SPACE, " ")
        out, run = [], bytearray()
        for i in ids:
            if (b := p.bytes_of.get(i)) is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            if i not in p.hidden:
                out.append(p.strings[i].replace(SPACE, " "))
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def _find(self, rest: str) -> str | tuple[str, str]:
        """A chunk, by what follows its first space, that is not among the latest ones."""
        if (found := self.older.get(rest)) is None:
            chunk = SPACE + rest
            if (taken := self._run(chunk)) is None:
                ids = self.chunk_ids(chunk)
                found = " ".join(map(str, ids))
            else:
                ids = [self.pieces.ids[p] for p in taken]
                found = " ".join([self.id_texts[p] for p in taken])
            decoded = self.decode_chunk(ids)
            if decoded != " " + rest.replace(SPACE, " "):
                found = (found, decoded)
        if len(rest) <= CACHE_CHARS:
            if len(self.known) >= CACHE_CHUNKS:  # the chunks seen since the last time go to the older half
                self.older, self.known = self.known, {}
            self.known[rest] = found
        return found

    def encode(self, text: str) -> list[int]:
        return [i for c in chunks(text) for i in self.chunk_ids(c)]

    def decode(self, ids: list[int]) -> str:
        return self.decode_chunk(ids).removeprefix(" ")

    def round_trip(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids joined by spaces, and their decoded text; chunk by chunk, as byte runs end with their chunk."""
        if not text:
            return 0, "", ""
        rests = text.split(" ")
        if SPACE in text or not all(rests):
            rests = [c[1:] for c in chunks(text)]
        parts = list(map(self.known.get, rests))
        odd = False
        for i in [i for i, p in enumerate(parts) if p.__class__ is not str]:
            if (p := parts[i]) is None:
                p = parts[i] = self.known.get(rests[i]) or self._find(rests[i])
            odd = odd or p.__class__ is not str
        if odd:
            joined = " ".join([p if p.__class__ is str else p[0] for p in parts])
            decoded = "".join([" " + r.replace(SPACE, " ") if p.__class__ is str else p[1] for p, r in zip(parts, rests, strict=True)]).removeprefix(" ")
        else:  # every chunk was found to decode to itself
            joined, decoded = " ".join(parts), text.replace(SPACE, " ")
        return joined.count(" ") + 1, joined, decoded


RESULTS = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType()), "ids_sha256": T.StringType(), "decoded": T.StringType(),
           "decoded_sha256": T.StringType()}


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


def encode_documents(docs: DataFrame, model_path: str, text_col: str = "text", carry: list[str] | None = None,
                     results: tuple[str, ...] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """The carried columns (all by default) and some of RESULTS, for the whole text of each row.

    ``ids`` end with the end id; ``decoded`` is the text read back from them; the digests are lowercase hex of the decimal ids joined by one
    space, and of the decoded text in UTF-8.  Null texts are encoded as empty ones (the end id only); rows are encoded
    one by one, so repeated rows stay repeated and an empty table gives no rows; carried columns with the name of a result give way to it.
    """
    model = shared_model(docs.sparkSession, model_path)
    added = T.StructType([T.StructField(r, RESULTS[r]) for r in results])
    types = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "ids_sha256": pa.string(), "decoded": pa.string(), "decoded_sha256": pa.string()}

    def make():
        encoder = in_worker(model, Encoder)
        eos = encoder.pieces.eos
        get = {
            "n_tokens": lambda n, _, __: n + 1,
            "ids": lambda _, joined, __: np.fromstring(f"{joined} {eos}", dtype=np.int32, sep=" "),
            "ids_sha256": lambda _, joined, __: _sha(f"{joined} {eos}" if joined else str(eos)),
            "decoded": lambda _, __, decoded: decoded,
            "decoded_sha256": lambda _, __, decoded: _sha(decoded),
        }
        take = [get[r] for r in results]

        def fn(texts):
            rows = [[f(*found) for f in take] for found in map(encoder.round_trip, (t or "" for t in texts))]
            return [pa.array([row[i] for row in rows], types[r]) for i, r in enumerate(results)]

        return fn

    return map_text(docs, text_col, added, make, carry)
