"""Language identification by compression: the language whose dictionary makes a text smallest.

Per language a raw-content zstandard dictionary is cut from labelled texts: pieces of PIECE bytes, each from a hashed place of one text, of
at most MAX_TEXTS texts, DICTIONARY bytes in all. A text is lower-cased and encoded in frames of FRAME bytes with every dictionary (whole, to its
end; frames keep the text's own history from drowning the dictionary); the smallest total wins, ties go to the language with more labelled texts.
The score is the margin, 1 - smallest / second smallest total.

with_known_language rejects a text without letters, and of the texts of LONG bytes or more (shorter ones often compress to the same number of bytes with several dictionaries and are kept)
those whose margin is under NARROW, which cannot be told between two languages, and those that the winner's dictionary compresses worse, in bytes a character, than SLACK times what it makes of all but
a hundredth (QUANTILE) of the labelled texts of that language and windows of them of about that length: they are of no learned language. These limits come from a fold of labelled texts of which no dictionary was
cut for that, at most about CALIBRATED a language; a length with fewer than ENOUGH of them takes the limit of the next shorter one that has enough, and without one rejects nothing. A foreign phrase repeated
over and over compresses by its own history and is told by its margin alone. More than MAX_LANGUAGES labelled languages fail, since their dictionaries are broadcast.

Defined cases: null, empty and letterless texts are `und` with score 0; without labelled texts every text is `und`; with one language it is
predicted with score 1; a null doc_id is not held out and never learned from; repeated rows are predicted alike; an empty table gives an empty result. Only doc_id and text are read of scored rows, doc_id, text and lang of labelled ones.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import crc_mod

MAX_TEXTS = 1200  # labelled texts a language's dictionary is cut from
PIECE = 128
DICTIONARY = 65_536
FRAME = 2048
LEVEL = 6
MAX_LANGUAGES = 200
NARROW, LONG = 0.002, 100  # a text of LONG bytes or more with a smaller margin is rejected
FOLDS = 5  # a fold of the labelled texts measures what dictionaries of the others give
CALIBRATED, ENOUGH = 2000, 10
QUANTILE, SLACK = 0.99, 1.15
LETTER = regex.compile(r"\p{L}")


Models = list[tuple[str, bytes, int]]


def _labelled(docs: DataFrame) -> DataFrame:
    return docs.filter("text is not null and lang is not null and doc_id is not null").filter(crc_mod("doc_id", 3) != 1)


def _counts(rows: DataFrame) -> dict[str, int]:
    """Labelled texts by language; partial aggregates keep their number."""
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labelled languages: their dictionaries would not fit into a broadcast")
    return {r["lang"]: r["n"] for r in counts}


def _thinned(counts: dict[str, int], most: float) -> Column:
    """Whether a row is among about `most` of its language, by a hash of its doc_id."""
    thin = F.lit(False)
    for lang, n in counts.items():
        thin = thin | ((F.col("lang") == lang) & (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < int(min(1.0, most / n) * (1 << 20)) + 1))
    return thin


def _fold() -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(FOLDS))


def _pieces(rows: DataFrame, counts: dict[str, int]) -> pd.DataFrame:
    """(lang, k, fold, piece) of at most MAX_TEXTS texts a language."""
    low = F.lower("text")
    size = F.length(low)
    start = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.greatest(F.lit(1), size - PIECE)) + 1
    # Thinning leaves about 4 * MAX_TEXTS ids of a language to be ranked, so that no window is large.
    pieces = rows.filter(_thinned(counts, 4.0 * MAX_TEXTS)).select("doc_id", "lang", _fold().alias("fold"), F.substring(low, start.cast("int"), F.lit(PIECE)).alias("piece"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "piece"))
    return pieces.withColumn("k", rank).filter(F.col("k") <= MAX_TEXTS).orderBy("lang", "k").toPandas()


def _models(table: pd.DataFrame, counts: dict[str, int]) -> Models:
    return [(lang, "\n".join(g["piece"]).encode("utf-8", "replace")[:DICTIONARY], counts[lang]) for lang, g in table.groupby("lang", sort=True)]


def fit(docs: DataFrame) -> Models:
    """(language, dictionary content, labelled texts) in order of language, from rows outside the held-out third."""
    rows = _labelled(docs)
    counts = _counts(rows)
    return _models(_pieces(rows, counts), counts) if counts else []


def fit_with_limits(docs: DataFrame) -> tuple[Models, dict[tuple[str, int], float]]:
    """The models, and by language and step of length the most compressed bytes a character that a text of the language has."""
    rows = _labelled(docs)
    counts = _counts(rows)
    if not counts:
        return [], {}
    table = _pieces(rows, counts)
    shared = docs.sparkSession.sparkContext.broadcast(_models(table[table["fold"] != 0], counts))

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tools = Compressors(shared.value)
        for f in frames:
            found = [(lang, m) for lang, text in zip(f["lang"], f["text"]) for m in map(tools.measured, windows(text)) if m[0] == lang]
            yield pd.DataFrame({"lang": [x[0] for x in found], "step": [length_step(m[3]) for _, m in found], "ratio": [m[2] for _, m in found]})

    sample = rows.filter(_thinned(counts, 1.0 * CALIBRATED * FOLDS)).filter(_fold() == 0).select("lang", "text")
    worst = sample.mapInPandas(measure, "lang string, step int, ratio double").groupBy("lang", "step").agg(F.percentile_approx("ratio", QUANTILE, 1000).alias("ratio"), F.count("*").alias("n"))
    limits = {(r["lang"], r["step"]): SLACK * r["ratio"] for r in worst.filter(F.col("n") >= ENOUGH).collect()}
    return _models(table, counts), limits


def windows(text: str) -> list[str]:
    """A text, and of every length of LONG characters or more that it exceeds one window at a place told by its checksum: short texts are too few to learn from."""
    out, step = [text], length_step(LONG)
    while step < length_step(FRAME) and (n := math.ceil(2 ** (step / 2))) < len(text):
        start = zlib.crc32(text.encode("utf-8", "replace")) % (len(text) - n)
        out.append(text[start : start + n])
        step += 1
    return out


def length_step(size: int) -> int:
    """Half-octave of a text's bytes, up to a frame's."""
    return int(2 * math.log2(min(FRAME, max(1, size))))


def limit_of(limits: dict[tuple[str, int], float], lang: str, size: int) -> float:
    """The limit at a length: of its step, or else of the next shorter one that has one."""
    return next((limits[lang, s] for s in range(length_step(size), -1, -1) if (lang, s) in limits), math.inf)


class Compressors:
    """One compressor a language."""

    def __init__(self, models: Models):
        self.by_language = []
        for lang, content, n in models:
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            tool = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False)
            self.by_language.append((lang, tool.compress, n))

    def measured(self, text: str | None) -> tuple[str, float, float, int]:
        """Language, margin, compressed bytes a character, and bytes."""
        if not text or not self.by_language or not LETTER.search(text):
            return "und", 0.0, 0.0, 0
        low = text.lower()
        raw = low.encode("utf-8", "replace")
        frames = [raw[at : at + FRAME] for at in range(0, len(raw), FRAME)]
        sizes = sorted((sum(len(pack(f)) for f in frames), -n, lang) for lang, pack, n in self.by_language)
        return sizes[0][2], 1.0 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0, sizes[0][0] / len(low), len(raw)

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.measured(text)[:2]


def predicted(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tools = Compressors(shared.value)
        for f in frames:
            found = [tools.predict(t) for t in f["text"]]
            yield pd.DataFrame({"doc_id": f["doc_id"], "lang_pred": [x[0] for x in found], "score": [x[1] for x in found]})

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id string, lang_pred string, score double").withColumn("doc_id", F.col("doc_id").cast("long"))


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    return predicted(docs, fit(docs)).select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def is_told(tools: Compressors, limits: dict[tuple[str, int], float], text: str | None) -> bool:
    """Whether a text's language is told: it has letters and is short, or is neither torn between two languages nor foreign to all."""
    lang, margin, ratio, size = tools.measured(text)
    return lang != "und" and (size < LONG or margin >= NARROW and ratio <= limit_of(limits, lang, size))


def with_known_language(docs: DataFrame) -> DataFrame:
    """The rows of docs whose language is told."""
    shared = docs.sparkSession.sparkContext.broadcast(fit_with_limits(docs))

    @F.pandas_udf("boolean")
    def told(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        models, limits = shared.value
        tools = Compressors(models)
        for texts in batches:
            yield pd.Series([is_told(tools, limits, t) for t in texts], dtype=bool)

    return docs.filter(told(F.col("text").cast("string")))
