"""SentencePiece encoding and decoding over a relational lattice.

A word's lattice is a relation: its substrings of bounded length are exploded, an equi-join with the piece table keeps those that are pieces, and the edges
are grouped by word. A fold with Spark's higher-order aggregate then finds the segmentation. For a unigram model it is Viterbi: the best score at every end,
then the path back. Scores of a BPE model are merge ranks, for which the path of highest sum is not what the library gives; there the fold replays
the merges on the same lattice: as long as two neighbouring symbols are an edge, the best-scored edge (of equals the leftmost) joins them.
Characters that are no piece become byte pieces.

Documents are encoded without moving their texts: the relational lattice encodes the corpus's common words, at most HEAD of them (counted over all rows,
broadcast); in every task they are looked up, and each remaining word (rarer, seen once, or of LONGEST_WORD characters and more) is folded in Python, by merges or by Viterbi, to
the same ids, once while it is remembered. Sending every word of every document through the join would shuffle more bytes than the texts have (see the README).

Defined cases: null and empty texts have no tokens; a word of any length takes n * log(n) steps; a literal space sign (U+2581) is a space, as the library has it, so such a text does not come back; an empty table
gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import materialise
from tessella.llm.pieces import SPACE, PieceTable, isolated, model_path, piece_table, read_model, segments_of_line

HEAD = 1 << 17  # words encoded by the relational lattice and broadcast
LONGEST_WORD = 32  # characters of such a word
WIDTH = 64  # start * WIDTH + end is an edge's key
BARE = 8  # the most frequent eighth of them also without the space sign, as they stand after a line feed
REMEMBERED = 700_000
HEAPED = 64  # characters of a word from which its merges are found by a heap
SCHEMA = "doc_id long, n_tokens long, token_ids array<int>, round_trip boolean"


def edges(words: DataFrame, table: PieceTable) -> DataFrame:
    """(word, start, end, score, id): every substring of a word that is a piece. words has the column word, of at most LONGEST_WORD characters."""
    schema = T.StructType([T.StructField("piece", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("id", T.IntegerType())])
    pieces = words.sparkSession.createDataFrame([(p, s, table.ids[p]) for p, s in table.scores.items()], schema)
    starts = words.select("word", F.explode(F.sequence(F.lit(0), F.char_length("word") - 1)).alias("start"))
    ends = F.sequence(F.col("start") + 1, F.least(F.char_length("word"), F.col("start") + table.longest))
    parts = starts.select("word", "start", F.explode(ends).alias("end"))
    parts = parts.withColumn("piece", F.expr("substring(word, start + 1, end - start)"))
    return parts.join(F.broadcast(pieces), "piece").select("word", "start", "end", "score", "id")  # the vocabulary bounds the broadcast


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def merge_fold(n: Column, scores: Column) -> Column:
    """Cuts (0 to n) after replaying the merges; scores maps start * WIDTH + end to the edge's score."""

    def step(cuts: Column, _: Column) -> Column:
        pairs = F.transform(
            F.when(F.size(cuts) > 2, F.sequence(F.lit(1), F.size(cuts) - 2)).otherwise(F.array().cast("array<int>")),
            lambda i: F.struct(F.element_at(scores, F.element_at(cuts, i) * WIDTH + F.element_at(cuts, i + 2)).alias("score"), (-i).alias("at")),
        )
        best = F.array_max(F.filter(pairs, lambda p: p["score"].isNotNull()))
        return _let(best, lambda b: F.when(b.isNull(), cuts).otherwise(F.concat(F.slice(cuts, F.lit(1), -b["at"]), F.slice(cuts, 2 - b["at"], F.size(cuts)))))

    return F.aggregate(F.sequence(F.lit(1), n), F.sequence(F.lit(0), n), step)


def viterbi_fold(n: Column, edge_list: Column, unknown: float) -> Column:
    """Cuts (0 to n) of the path with the highest sum of scores; a character without an edge costs `unknown`.

    edge_list: array of (start, end, score). Of equal sums the edge that starts first wins.
    """

    def step(best: Column, end: Column) -> Column:
        into = F.filter(edge_list, lambda e: e["end"] == end)
        reached = F.transform(into, lambda e: F.struct((F.element_at(best, e["start"] + 1)["score"] + e["score"]).alias("score"), (-e["start"]).alias("from")))
        single = F.struct((F.element_at(best, end)["score"] + F.lit(unknown)).alias("score"), (F.lit(1) - end).alias("from"))
        has_single = F.exists(into, lambda e: e["start"] == end - 1)
        options = F.when(has_single, reached).otherwise(F.concat(reached, F.array(single)))
        return F.concat(best, F.array(F.array_max(options)))

    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("from")))
    best = F.aggregate(F.sequence(F.lit(1), n), first, step)

    def back(cuts: Column, _: Column) -> Column:
        head = F.element_at(cuts, 1)
        return F.when(head <= 0, cuts).otherwise(F.concat(F.array(-F.element_at(best, head + 1)["from"]), cuts))

    return F.aggregate(F.sequence(F.lit(1), n), F.array(n), back)


def encode_words(words: DataFrame, table: PieceTable) -> DataFrame:
    """word, ids: distinct non-empty words of at most LONGEST_WORD characters through the relational lattice."""
    distinct = words.select("word").distinct()
    found = edges(distinct, table).groupBy("word").agg(F.collect_list(F.struct("start", "end", "score", "id")).alias("edges"))
    full = distinct.join(found, "word", "left").withColumn("edges", F.coalesce("edges", F.array().cast("array<struct<start:int,end:int,score:double,id:int>>")))
    key = lambda e: e["start"] * WIDTH + e["end"]
    full = full.withColumn("n", F.char_length("word"))
    full = full.withColumn("scores", F.map_from_arrays(F.transform("edges", key), F.transform("edges", lambda e: e["score"])))
    full = full.withColumn("at", F.map_from_arrays(F.transform("edges", key), F.transform("edges", lambda e: e["id"])))
    low = table.lowest - 10.0
    cuts = merge_fold(F.col("n"), F.col("scores")) if table.merges else viterbi_fold(F.col("n"), F.col("edges"), low)
    full = full.withColumn("cuts", cuts)
    byte_ids = F.array(*map(F.lit, table.bytes_at))

    def ids_of(i: Column) -> Column:
        start, end = F.element_at("cuts", i), F.element_at("cuts", i + 1)
        hexed = F.hex(F.encode(F.substring(F.col("word"), start + 1, end - start), "UTF-8"))
        spelled = F.transform(
            F.sequence(F.lit(1), F.length(hexed), F.lit(2)), lambda p: F.element_at(byte_ids, F.conv(F.substring(hexed, p, F.lit(2)), 16, 10).cast("int") + 1)
        )
        piece = F.element_at("at", start * WIDTH + end)
        return F.when(piece.isNotNull(), F.array(piece)).otherwise(spelled)

    return full.select("word", F.flatten(F.transform(F.sequence(F.lit(1), F.size("cuts") - 1), ids_of)).alias("ids"))


def common_words(docs: DataFrame) -> DataFrame:
    """The corpus's most frequent words with a space sign in front, the top ones without as well: at most HEAD, by a least count.

    Counts cover all rows. The least count comes from a histogram over eighths of octaves, so that no task ranks all words.
    """
    words = docs.select(F.explode(F.split(F.translate(F.col("text").cast("string"), f"\n{SPACE}", "  "), " ")).alias("w")).filter("w != ''")
    counted = materialise(words.groupBy("w").agg(F.count("*").alias("n")).filter((F.col("n") > 1) & (F.char_length("w") < LONGEST_WORD)), "lattice-words")
    octave = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    histogram = counted.groupBy(octave.alias("octave")).agg(F.count("*").alias("words")).orderBy(F.desc("octave")).collect()
    least, taken = None, 0
    for row in histogram:
        taken += row["words"]
        if taken > HEAD - HEAD // BARE:
            break
        least = row["octave"]
    if least is None:
        return counted.limit(0).select(F.col("w").alias("word"))
    spaced = counted.filter(octave >= least).select(F.concat(F.lit(SPACE), F.col("w")).alias("word"))
    frequent = [row["octave"] for row, words in zip(histogram, _running(histogram)) if words <= HEAD // BARE]
    return spaced.union(counted.filter(octave >= min(frequent)).select("w")) if frequent else spaced


def _running(histogram: list) -> list[int]:
    total, out = 0, []
    for row in histogram:
        total += row["words"]
        out.append(total)
    return out


def viterbi_word(word: str, table: PieceTable) -> list[str]:
    """Pieces of the path with the highest sum of scores; a character that is no piece costs as in viterbi_fold."""
    low, none = table.lowest - 10.0, float("-inf")
    best, back = [0.0] + [none] * len(word), [0] * (len(word) + 1)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - table.longest), end):
            score = table.scores.get(word[start:end], low if end - start == 1 else none)
            if best[start] + score > best[end]:
                best[end], back[end] = best[start] + score, start
    out, end = [], len(word)
    while end:
        out.append(word[back[end] : end])
        end = back[end]
    return out[::-1]


def fold_word(word: str, table: PieceTable) -> list[int]:
    """One word to the ids that encode_words gives, outside Spark."""
    return ids_of(merged_word(word, table) if table.merges else viterbi_word(word, table), table)


def merged_word(word: str, table: PieceTable) -> list[str]:
    """Symbols after replaying the merges. Longer words than HEAPED take n * log(n) steps by a heap, shorter ones a scan a merge."""
    if len(word) > HEAPED:
        return _merged_by_heap(word, table)
    score, none = table.scores.get, float("-inf")
    symbols = list(word)
    pairs = [score(a + b, none) for a, b in zip(symbols, symbols[1:])]  # an edge's score, or none
    while pairs:
        best = max(pairs)
        if best == none:
            break
        at = pairs.index(best)  # the leftmost
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = score(symbols[at] + symbols[at + 1], none)
        if at:
            pairs[at - 1] = score(symbols[at - 1] + symbols[at], none)
    return symbols


def _merged_by_heap(word: str, table: PieceTable) -> list[str]:
    """merged_word for words of any length: edges in a heap by score and place. An edge is out of date where its two symbols are longer by now."""
    score, symbols, after, before = table.scores.get, list(word), list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    edges = [(-found, at, 2) for at, (a, b) in enumerate(zip(word, word[1:])) if (found := score(a + b)) is not None]
    heapify(edges)

    def push(at: int) -> None:
        if at >= 0 and after[at] < len(word):
            pair = symbols[at] + symbols[after[at]]
            if (found := score(pair)) is not None:
                heappush(edges, (-found, at, len(pair)))

    while edges:
        _, at, size = heappop(edges)
        to = after[at]
        if not symbols[at] or to >= len(word) or len(symbols[at]) + len(symbols[to]) != size:
            continue
        symbols[at], symbols[to], after[at] = symbols[at] + symbols[to], "", after[to]
        if after[at] < len(word):
            before[after[at]] = at
        push(at)
        push(before[at])
    return [s for s in symbols if s]


def ids_of(symbols: list[str], table: PieceTable) -> list[int]:
    """Ids of pieces, of bytes where a symbol is no piece."""
    out: list[int] = []
    for symbol in symbols:
        known = table.ids.get(symbol)
        if known is not None:
            out.append(known)
        else:
            out.extend(table.bytes_at[x] for x in symbol.encode("utf-8", "surrogatepass"))
    return out


class _Known(dict):
    """Segment -> its ids as little-endian 32-bit integers; keeps the broadcast words and, until full, the others met.

    Keys leave out the prefix that all of its segments begin with.
    """

    def __init__(self, table: PieceTable, prefix: str, head: dict[str, bytes]):
        super().__init__(head)
        self.table, self.prefix, self.head = table, prefix, head

    def __missing__(self, rest: str) -> bytes:
        found = np.array(fold_word(self.prefix + rest, self.table), "<i4").tobytes()
        if len(self) > REMEMBERED + len(self.head):
            self.clear()
            self.update(self.head)
        if len(rest) <= 256:
            self[rest] = found
        return found


class Encoder:
    """Texts to ids; head maps words, with or without a space sign in front, to their ids."""

    def __init__(self, table: PieceTable, head: dict[str, bytes]):
        self.table = table
        self.spaced = _Known(table, SPACE, {w[1:]: i for w, i in head.items() if w[0] == SPACE})
        self.bare = _Known(table, "", {w: i for w, i in head.items() if w[0] != SPACE})

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        out: list[bytes] = []
        spaced, bare = self.spaced.__getitem__, self.bare.__getitem__
        for k, line in enumerate(text.split("\n")):
            words = line.split(" ")
            if k:
                out.append(bare("\n"))
            if "" in words or SPACE in line:  # several space signs together
                if line or not k:
                    out.extend(map(bare, segments_of_line(line, self.table, not k)))
            elif k:
                out.append(bare(words[0]))
                out.extend(map(spaced, words[1:]))
            else:
                out.extend(map(spaced, words) if self.table.dummy_prefix else (bare(words[0]), *map(spaced, words[1:])))
        return b"".join(out)


class Decoder:
    """Ids back to text."""

    def __init__(self, table: PieceTable):
        size = max([*table.ids.values(), *table.bytes_at]) + 1
        self.parts = [b""] * size
        for piece, i in table.ids.items():
            self.parts[i] = piece.replace(SPACE, " ").encode("utf-8", "surrogatepass")
        for b, i in enumerate(table.bytes_at):
            self.parts[i] = bytes([b])
        self.dummy = table.dummy_prefix

    def decode(self, ids) -> str:
        raw = b"".join(map(self.parts.__getitem__, ids))
        return (raw[1:] if self.dummy and raw[:1] == b" " else raw).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, token_ids, and round_trip: whether decoding gives the text again."""
    table = piece_table(read_model(path or model_path()))
    if not isolated(table, "\n"):
        raise ValueError("texts cannot be cut at line feeds")
    head = encode_words(common_words(docs), table).toArrow()
    known = {w: np.array(i, "<i4").tobytes() for w, i in zip(head["word"].to_pylist(), head["ids"].to_pylist())}
    shared = docs.sparkSession.sparkContext.broadcast((table, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(*shared.value), Decoder(shared.value[0])
        for whole in batches:
            for at in range(0, whole.num_rows, 500):  # bounded lists of ids
                batch = whole.slice(at, 500)
                found, same = [], []
                for text in batch.column(1).to_pylist():
                    ids = np.frombuffer(encoder.encode(text or ""), "<i4")
                    found.append(ids)
                    same.append(decoder.decode(ids.tolist()) == (text or ""))
                sizes = np.array([len(x) for x in found], np.int64)
                offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                values = pa.array(np.concatenate(found).astype(np.int32))
                columns = [batch.column(0), pa.array(sizes), pa.ListArray.from_arrays(offsets, values), pa.array(same)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "token_ids", "round_trip"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
