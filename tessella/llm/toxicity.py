"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities and counts of learned lexicon words in three strengths, second-person words near them, capitals, punctuation,
and obfuscation (digits or signs inside words that hide a lexicon word). The lexicon holds words and word beginnings whose document frequency
differs between toxic and clean labelled texts; near copies count once, by the least hash of a text's pairs of words. The trees see lexicon features
from a lexicon that leaves out the row's own fold, so memorised words earn no trust. Calibration uses out-of-fold scores.

The model is fitted on at most MAX_TOXIC + MAX_CLEAN labelled documents (those of smallest hash), with at most MAX_LEXICON lexicon entries; both classes are counted over all
labelled documents, and each sampled one weighs as many as it stands for, so the cut at one half does not move with the sample. Scoring covers every row.

Defined cases: a null text is scored as an empty one; empty texts get the score of their features (all zero); with fewer than LEAST_LABELS labelled rows of
either class every score is the toxic share (0 without labels) and no document is filtered out; labels that contradict each other for one doc_id count as toxic; of several texts of a labelled doc_id the first in byte order is learned from; a null doc_id is
not held out and never learned from; an empty table gives an empty result. Only doc_id and text are read; no label, lang, source or doc_id is an input of a score.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.boosting import BoostedTrees, Isotonic
from tessella.llm.common import crc_mod, materialise, small_batches

MAX_TOXIC, MAX_CLEAN = 4000, 8000
MAX_LEXICON = 20_000
LEAST_LABELS = 5  # rows of either class below which nothing is learned
FOLDS = 4
PREFIXES = range(3, 8)
STRONG, MEDIUM, WEAK = 4.2, 2.8, 1.8  # lower bounds of an entry's log odds
DEVIATIONS = 1.5  # standard errors that the bound lies below the estimate
NEAR = 5  # words
CACHE = 150_000
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch usted ustedes ti vosotros".split())
LEET = str.maketrans("013457@$!8", "oieastasib")
EDGES = string.punctuation + "«»“”‘’¡¿…"
NOT_LETTERS = re.compile(r"[^a-zß-öø-ÿœ]+")
N_FEATURES = 20
_ASCII = np.zeros((7, 256))
for _row, _chars in enumerate((string.ascii_uppercase, string.ascii_letters, string.digits, "!", "?", "*@$#%&", ".,;:'\"-")):
    _ASCII[_row, [ord(c) for c in _chars]] = 1


def forms(word: str) -> tuple[list[str], str | None]:
    """The readings of a lower-case token: its core and letter parts; and the letters left after undoing obfuscation."""
    core = word.strip(EDGES)
    if core.isalpha():
        return [core], None
    plain = [p for p in NOT_LETTERS.split(core) if len(p) > 2]
    undone = NOT_LETTERS.sub("", core.translate(LEET))
    return plain, undone if len(undone) > 2 and undone not in plain else None


def entries(form: str) -> list[str]:
    """Lexicon keys of a reading: the whole word (=word) and its beginnings."""
    return ["=" + form, *(form[:k] for k in PREFIXES if k < len(form))]


class _Scores(dict):
    """Token -> bound of its best lexicon entry; -1 for second-person words; plus 100 if only undoing obfuscation finds it."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        plain, undone = forms(word)
        best = max((self.lexicon.get(e, 0.0) for f in plain for e in entries(f)), default=0.0)
        if undone:
            hidden = max((self.lexicon.get(e, 0.0) for e in entries(undone)), default=0.0)
            if hidden > best:
                best = hidden + 100
        if not best and any(f in SECOND_PERSON for f in plain):
            best = -1.0
        if len(self) > CACHE:
            self.clear()
        self[word] = best
        return best


def features(text: str, scores: _Scores) -> np.ndarray:
    out = np.zeros(N_FEATURES)
    words = text.lower().split()
    if not words:
        return out
    n = len(words)
    z = np.fromiter(map(scores.__getitem__, words), np.float64, n)
    hidden = z >= 100
    z[hidden] -= 100
    strong, medium, weak = (z >= STRONG).sum(), ((z >= MEDIUM) & (z < STRONG)).sum(), ((z >= WEAK) & (z < MEDIUM)).sum()
    out[:8] = np.log1p(n), strong / n, medium / n, weak / n, np.log1p(strong), np.log1p(medium), np.log1p(weak), z.max(initial=0)
    hits, you = np.flatnonzero(z >= WEAK), np.flatnonzero(z == -1)
    out[9] = 50
    if len(hits) and len(you):
        at = np.searchsorted(you, hits)
        gap = np.minimum(np.abs(you[np.minimum(at, len(you) - 1)] - hits), np.abs(you[np.maximum(at - 1, 0)] - hits))
        out[8], out[9] = (gap <= NEAR).mean(), min(50, gap.min())
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    capitals, letters, digits, bang, ask, signs, stops = _ASCII @ np.bincount(raw, minlength=256)
    size = len(raw)
    out[10:16] = capitals / max(1, letters), bang / size, ask / size, signs / size, stops / size, digits / size
    out[16] = hidden.sum() / n
    out[17] = np.maximum(z, 0).sum() / n
    out[18] = letters / size
    out[19] = (z >= MEDIUM).sum()
    return out


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: BoostedTrees | None
    calibration: Isotonic | None
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.prior)
        return self.calibration(self.trees.decision(x))


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id and toxic of every labelled document outside the held-out fifth."""
    return labels.filter("doc_id is not null and toxic in (0, 1)").filter(crc_mod("doc_id", 5) != 0).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def _sample(known: DataFrame) -> DataFrame:
    """At most MAX_TOXIC toxic and MAX_CLEAN clean ids, those of smallest hash."""
    parts = [known.filter(f"toxic = {t}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for t, n in ((1, MAX_TOXIC), (0, MAX_CLEAN))]
    return parts[0].union(parts[1])


def _words_of(text: str) -> set[str]:
    found: set[str] = set()
    for word in set(text.lower().split()):
        plain, undone = forms(word)
        found.update(plain)
        if undone:
            found.add(undone)
    found.discard("")
    return found


def group_of(text: str) -> int:
    """The least hash of a text's pairs of words: mostly the same for near copies, mostly different for other texts."""
    words = text.lower().split()
    return min((zlib.crc32(f"{a} {b}".encode("utf-8", "replace")) for a, b in zip(words, words[1:])), default=zlib.crc32(" ".join(words).encode("utf-8", "replace")))


def _entry_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for text, toxic, grp in zip(frame["text"], frame["toxic"], frame["grp"]):
            words = _words_of(text)
            if words:
                found = list({e for w in words for e in entries(w)})
                yield pd.DataFrame({"entry": found, "toxic": np.int32(toxic), "grp": grp})


def _grouped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield f.assign(grp=[group_of(t) for t in f["text"]])


def _lexicon(counts: pd.DataFrame, totals: dict[tuple[int, int], int], without: int | None) -> dict[str, float]:
    """Lower bound of each entry's log odds over the folds other than `without`."""
    folds = [f for f in range(FOLDS) if f != without]
    toxic, clean = (counts[[f"c{f}_{t}" for f in folds]].sum(axis=1).to_numpy(float) for t in (1, 0))
    n_toxic, n_clean = (sum(totals.get((f, t), 0) for f in folds) for t in (1, 0))
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    z = odds - DEVIATIONS * np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    keep = (toxic >= 2) & (z >= WEAK)
    return dict(zip(counts["entry"].to_numpy()[keep], z[keep]))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit lexicon, trees and calibration on the bounded sample of labelled rows."""
    spark = docs.sparkSession
    # The sample's ids are bounded by MAX_TOXIC + MAX_CLEAN rows, so they are broadcast and texts are not shuffled.
    known = materialise(known_labels(labels), "toxicity-labels")
    whole = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = F.broadcast(_sample(known))
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(chosen, "doc_id")
    # One text a document, so that the sample's bound holds whatever rows repeat a doc_id.
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")
    # Groups are told once, as the sample is written, so that no later task needs two Python workers.
    fold = F.pmod(F.xxhash64("grp"), F.lit(FOLDS)).cast("int")
    texts = materialise(texts.mapInPandas(_grouped, "text string, toxic int, grp long").withColumn("fold", fold), "toxicity-sample")
    classes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2 or min(classes.values()) < LEAST_LABELS:
        return ToxicityModel({}, None, None, classes.get(1, 0) / max(1, sum(classes.values())))
    seen = texts.mapInPandas(_entry_rows, "entry string, toxic int, grp long").distinct().withColumn("fold", fold)
    cells = [F.count_if((F.col("fold") == f) & (F.col("toxic") == t)).alias(f"c{f}_{t}") for f in range(FOLDS) for t in (0, 1)]
    counts = seen.groupBy("entry").agg(*cells)
    toxic = sum((F.col(f"c{f}_1") for f in range(1, FOLDS)), F.col("c0_1"))
    clean = sum((F.col(f"c{f}_0") for f in range(1, FOLDS)), F.col("c0_0"))
    # Ordered by how surely an entry marks toxic texts; the bound is the lexicon's documented size.
    bound = F.log((toxic + 0.5) / (clean + 0.5)) - DEVIATIONS * F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    counts = counts.filter(toxic >= 2).orderBy(bound.desc(), "entry").limit(MAX_LEXICON).toPandas()
    totals = {(r["fold"], r["toxic"]): r["n"] for r in texts.select("fold", "toxic", "grp").distinct().groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    lexicons = [_lexicon(counts, totals, f) for f in range(FOLDS)]
    shared = spark.sparkContext.broadcast(lexicons)

    def featured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = [_Scores(x) for x in shared.value]
        for f in frames:
            rows = [features(t, tables[k]).tolist() for t, k in zip(f["text"], f["fold"])]
            yield pd.DataFrame({"toxic": f["toxic"], "fold": f["fold"], "x": rows})

    table = texts.select("text", "toxic", "fold").mapInPandas(featured, "toxic int, fold int, x array<double>").toPandas()
    x, y, folds = np.array(table["x"].tolist()), table["toxic"].to_numpy(float), table["fold"].to_numpy()
    order = np.lexsort((*x.T, y, folds))  # the model does not depend on the order in which rows arrive
    x, y, folds = x[order], y[order], folds[order]
    # Documents without a text at hand are missing from both classes alike; the mean weight is one.
    weight = np.where(y == 1, whole[1] / classes[1], whole[0] / classes[0])
    weight /= weight.mean()
    rest = np.full(len(y), np.nan)
    for f in range(FOLDS):
        if (folds == f).any() and len(set(y[folds != f])) == 2:
            rest[folds == f] = BoostedTrees().fit(x[folds != f], y[folds != f], weight[folds != f]).decision(x[folds == f])
    trees = BoostedTrees().fit(x, y, weight)
    rest = np.where(np.isnan(rest), trees.decision(x), rest)
    return ToxicityModel(_lexicon(counts, totals, None), trees, Isotonic().fit(rest, y, weight), float(np.average(y, weights=weight)))


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Every row of docs (doc_id and text) with its score and the prediction at one half."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted = shared.value
        table = _Scores(fitted.lexicon)
        for f in frames:
            x = np.array([features(t, table) for t in f["text"]]).reshape(len(f), N_FEATURES)
            yield pd.DataFrame({"doc_id": f["doc_id"], "score": np.clip(fitted.score(x), 0, 1)})

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    scored = rows.mapInPandas(run, "doc_id string, score double")
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    scored = score_documents(docs, fit(docs, labels))
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def kept(batches: Iterator[pa.Array], model: ToxicityModel) -> Iterator[pa.Array]:
    """Which texts are not predicted toxic; one text of a batch at a time becomes a Python string."""
    table = _Scores(model.lexicon)
    for texts in batches:
        x = np.array([features(t.as_py() or "", table) for t in texts]).reshape(len(texts), N_FEATURES)
        yield pa.array(model.score(x) < 0.5)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not predicted toxic, every column kept; texts are read and passed on, not shuffled."""
    small_batches(docs.sparkSession)
    model = fit(docs, labels)
    if model.trees is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def keep(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return kept(batches, shared.value)

    return docs.filter(keep(F.col("text").cast("string")))
