"""A piece vocabulary (public model file), read once on the driver and handed to the tasks as bytes."""

from __future__ import annotations

import re

import sentencepiece
from pyspark.sql import SparkSession

from tablefit.llm.common import hand_out

SPACE = "▁"  # stands for a space in pieces
_CHUNKS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: A vocabulary file is bounded by its number of pieces; larger files are refused rather than broadcast.
MAX_MODEL_BYTES = 64 * 1024 * 1024


def shared_model(spark: SparkSession, path: str):
    """The model file's bytes, handed out to the workers."""
    with open(path, "rb") as f:
        data = f.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    return hand_out(spark, data)


class Pieces:
    """Pieces that texts can be made of: ``ids`` by piece, ``scores`` by piece, ``byte_ids`` by byte; ``strings`` of all ids."""

    def __init__(self, model: bytes) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.strings = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        plain = [i for i in range(len(self.strings)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {self.strings[i]: i for i in plain}
        self.scores = {self.strings[i]: sp.get_score(i) for i in plain}
        self.byte_ids = {int(s[3:5], 16): i for i, s in enumerate(self.strings) if sp.is_byte(i)}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        self.hidden = {i for i in range(len(self.strings)) if sp.is_control(i)}
        self.eos = sp.eos_id()
        self.special = frozenset(self.bytes_of) | self.hidden
        if len(self.byte_ids) != 256:
            raise ValueError("the vocabulary has no byte pieces to fall back on")
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces that go on after a space are not supported")
        if any(c not in self.ids for p in self.ids for c in p):
            raise ValueError("a piece holds a character that is no piece itself")


def chunks(text: str) -> list[str]:
    """The text with a space put before it, cut in front of each run of spaces; no piece crosses these cuts."""
    if not text:
        return []
    if SPACE not in text:
        words = text.split(" ")
        if all(words):
            return [SPACE + w for w in words]
    return _CHUNKS.findall(SPACE + text.replace(" ", SPACE))
