"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is put to the library: those that encode alone as exactly one token are counted as one wherever they stand as a
segment (a word with the space signs before it, or what follows a line feed). All other segments are merged by the library, each once per task
while it is remembered. Segments are independent: no piece holds a space sign after another character, and none but its own byte piece a line feed;
both are checked when the model is read.

Defined cases: null and empty texts have 0 tokens and 0 bytes; special strings are ordinary text, as the library has it; an empty
table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.pieces import SPACE, isolated, model_path, piece_table, prepared, read_model, SEGMENT

REMEMBERED = 400_000


def whole_tokens(model: bytes) -> tuple[frozenset[str], frozenset[str]]:
    """Strings that encode as one token: words after a space sign (the sign left out), and strings after a line feed."""
    table, tool = piece_table(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    if not isolated(table, "\n") or len(tool.encode("a\nb")) != 3:
        raise ValueError("line feeds are not tokens of their own")
    words = [p[1:] for p in table.scores if p[0] == SPACE and len(p) > 1 and SPACE not in p[1:]]
    bare = [p for p in table.scores if SPACE not in p]
    return (
        frozenset(w for w, ids in zip(words, tool.encode(words)) if len(ids) == 1),
        frozenset(p for p, ids in zip(bare, tool.encode(["\n" + p for p in bare])) if len(ids) == 3),
    )


class _Counts(dict):
    """Segment -> tokens; starts from the proven whole tokens, forgets the rest when full."""

    def __init__(self, whole: frozenset[str], count):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.count = whole, count

    def __missing__(self, segment: str) -> int:
        n = self.count(segment)
        if len(self) > REMEMBERED + len(self.whole):
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        if len(segment) <= 256:  # bounds what is remembered
            self[segment] = n
        return n


class TokenCounter:
    def __init__(self, model: bytes, whole: tuple[frozenset[str], frozenset[str]]):
        self.table, self.tool = piece_table(model), sentencepiece.SentencePieceProcessor(model_proto=model)
        self.words = _Counts(whole[0], lambda w: len(self.tool.encode(w)))
        self.bare = _Counts(whole[1], lambda p: len(self.tool.encode("\n" + p)) - 2)

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        total = text.count("\n")
        word, bare = self.words.__getitem__, self.bare.__getitem__
        for k, line in enumerate(text.split("\n")):
            parts = line.split(" ")
            if "" in parts or SPACE in line:  # several space signs together: they merge with each other
                for part in SEGMENT.findall(prepared(line, self.table) if not k else line.replace(" ", SPACE)):
                    single = part[0] == SPACE and part[1:2] not in ("", SPACE)
                    total += word(part[1:]) if single else bare(part)
                if not line and not k:
                    total += bare(SPACE)  # the text begins with a line feed
                continue
            if k:
                total += bare(parts[0])
                parts = parts[1:]
            total += sum(map(word, parts))
        return total


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    model = read_model(path or model_path())
    shared = docs.sparkSession.sparkContext.broadcast((model, whole_tokens(model)))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = TokenCounter(*shared.value)
        for texts in batches:
            yield pd.Series([counter(t) for t in texts], dtype="int64")

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), count(text).alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
