"""What the SentencePiece operators share: reading a model, cutting texts into segments that no piece crosses."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

import sentencepiece

SPACE = "▁"
SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
DEFAULT_MODEL = "piece_bpe_32k.model"


def model_path(name: str = DEFAULT_MODEL) -> str:
    """Where the public tokenizers' package keeps a model."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read_model(path: str) -> bytes:
    """A model file's bytes; the driver reads them and broadcasts them, so executors need no file."""
    with open(path, "rb") as file:
        return file.read()


@dataclass(frozen=True)
class PieceTable:
    """Pieces by text with their scores, the ids of byte pieces, and how a text is prepared."""

    scores: dict[str, float]
    ids: dict[str, int]
    bytes_at: tuple[int, ...]
    unknown: int
    merges: bool  # a BPE model: scores are merge ranks; else a unigram model: scores are log probabilities
    longest: int
    dummy_prefix: bool

    @cached_property
    def lowest(self) -> float:
        """The lowest score of a piece."""
        return min(self.scores.values())


def piece_table(model: bytes) -> PieceTable:
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    tool = sentencepiece.SentencePieceProcessor(model_proto=model)
    normal = [(i, p) for i, p in enumerate(proto.pieces) if p.type == p.NORMAL]
    spec = proto.normalizer_spec
    if spec.name != "identity" or spec.remove_extra_whitespaces or not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only models without normalisation are supported")
    if any(SPACE in p.piece.lstrip(SPACE) for _, p in normal):
        raise ValueError("a piece crosses the start of a word")
    at = tuple(tool.piece_to_id(f"<0x{b:02X}>") for b in range(256))
    if tool.unk_id() in at:
        raise ValueError("the model has no byte pieces")
    return PieceTable(
        {p.piece: p.score for _, p in normal}, {p.piece: i for i, p in normal}, at, tool.unk_id(),
        proto.trainer_spec.model_type == 2, max(len(p.piece) for _, p in normal), spec.add_dummy_prefix,
    )


def isolated(table: PieceTable, char: str) -> bool:
    """Whether no piece of several characters holds char, so that texts can be cut beside it."""
    return not any(char in p for p in table.scores if len(p) > 1)


def prepared(text: str, table: PieceTable) -> str:
    """Spaces as the space sign, with one in front."""
    return (SPACE if table.dummy_prefix else "") + text.replace(" ", SPACE) if text else ""


def segments_of_line(line: str, table: PieceTable, first: bool) -> list[str]:
    """The segments of one line of a text: space signs with what follows them. The first line begins with the dummy prefix."""
    return SEGMENT.findall((SPACE if first and table.dummy_prefix else "") + line.replace(" ", SPACE))


def segments(text: str, table: PieceTable) -> list[str]:
    """All segments of a text, its line feeds among them."""
    parts: list[str] = []
    for k, line in enumerate(text.split("\n") if text else ()):
        if k:
            parts.append("\n")
        parts.extend(segments_of_line(line, table, not k))
    return parts
