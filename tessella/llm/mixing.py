"""Temperature mixing: source shares to the power alpha, alpha found by bisection, budgets realised as block permutations.

alpha = 1 keeps the sources' token shares, alpha = 0 makes all sources equal. The search takes the largest
flattening wanted (a target entropy, as a fraction of the entropy of equal weights) and holds it back where
a source would be repeated more often than allowed. A source's integer token budget becomes whole epochs
over all its rows plus a last, partial epoch. Every epoch is a permutation by blocks: rows hash into blocks
of about BLOCK_ROWS (rows without doc_id by their text), blocks are ordered by a hash of (seed, epoch, block), rows within them by a hash of
(seed, epoch, doc_id); the partial epoch takes rows until its tokens are spent. `position` (0 to 1) merges
the sources: any prefix of it holds them in the target proportions.

Defined cases: a null text has no tokens; a null source is a source of its own; a source without tokens
gets weight 0 and its rows, which cost nothing, appear once; one source gets weight 1; repeated rows are
rows of their own; rows without doc_id are dealt by their text; an empty table gives an empty result. Only
doc_id, text and source are read; mixed_documents keeps all columns, of any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import materialise, unused

BLOCK_ROWS = 1024
WAYS = 32  # sections of the exponent's interval that one pass tells apart
PASSES = 6  # 32^6 = 2^30 sections


def count_words(text: str = "text") -> Column:
    """Tokens as the mixture counts them: runs without ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _md5_long(*parts: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary")), 1, 8), 16, 10).cast("long")


def find_alpha(totals: DataFrame, entropy: float, max_repeats: float, budget: int | None) -> float:
    """The exponent, rounded up to six decimals.

    Each pass evaluates 33 exponents in one aggregate over the source table and keeps the section in which
    the predicate turns (bisection, 32 ways at once), so any number of sources is handled without
    collecting them. The predicate holds for large alpha: entropy at most the target, or repeats beyond the
    limit no longer occurring.
    """
    live = totals.filter("source_tokens > 0")
    facts = live.agg(F.count("*").alias("n"), F.sum("source_tokens").alias("t"), F.min("source_tokens").alias("lo"), F.max("source_tokens").alias("hi")).first()
    if not facts["n"] or facts["n"] < 2:
        return 1.0
    total, p_min, p_max, n = facts["t"], facts["lo"] / facts["t"], facts["hi"] / facts["t"], facts["n"]
    share = F.col("source_tokens") / F.lit(float(total))

    def section(enough) -> float:
        lo, hi = 0.0, 1.0
        for _ in range(PASSES):
            at = [lo + (hi - lo) * k / WAYS for k in range(WAYS + 1)]
            sums = [f for k, a in enumerate(at) for f in (F.sum(F.pow(share, F.lit(a))).alias(f"z{k}"), F.sum(F.pow(share, F.lit(a)) * F.log(share)).alias(f"s{k}"))]
            row = live.agg(*sums).first()
            k = next((k for k, a in enumerate(at) if enough(a, row[f"z{k}"], row[f"s{k}"])), None)
            if k is None:
                return 1.0
            if k == 0:
                return at[0]
            lo, hi = at[k - 1], at[k]
        return hi

    def repeats(a: float, z: float) -> float:
        spent = budget / total if budget else z * p_max ** (1 - a)
        return spent * p_min ** (a - 1) / z

    wanted = section(lambda a, z, s: math.log(z) - a * s / z <= entropy * math.log(n) + 1e-12)
    allowed = section(lambda a, z, s: repeats(a, z) <= max_repeats * (1 + 1e-12))
    return math.ceil(max(wanted, allowed) * 1e6) / 1e6


def source_plan(rows: DataFrame, entropy: float, max_repeats: float, budget: int | None) -> DataFrame:
    """One row per source: totals, weight, integer budget, whole epochs, remaining tokens, blocks.

    budget None means the smallest total at which every source is read in full at least once.
    """
    totals = materialise(rows.groupBy("source_key").agg(F.count("*").alias("source_rows"), F.sum("tokens").alias("source_tokens")), "mixing-sources")
    alpha = find_alpha(totals, entropy, max_repeats, budget)
    sums = totals.agg(F.sum("source_tokens").alias("t"), F.max("source_tokens").alias("hi")).first()
    total, p_max = float(sums["t"] or 0) or 1.0, (sums["hi"] or 0) / (float(sums["t"] or 0) or 1.0)
    raised = F.when(F.col("source_tokens") > 0, F.pow(F.col("source_tokens") / F.lit(total), F.lit(alpha))).otherwise(F.lit(0.0))
    z = totals.agg(F.sum(raised).alias("z")).first()["z"] or 1.0
    spent = float(budget) if budget else total * z * p_max ** (1 - alpha)
    weight = raised / F.lit(z)
    planned = totals.withColumn("alpha", F.lit(alpha)).withColumn("weight", weight).withColumn("budget", F.round(weight * F.lit(spent)).cast("long"))
    return planned.withColumns(
        {
            "epochs": F.when(F.col("source_tokens") > 0, F.expr("budget div source_tokens")).otherwise(F.lit(1)).cast("int"),
            "rest": F.when(F.col("source_tokens") > 0, F.expr("budget % source_tokens")).otherwise(F.lit(0)).cast("long"),
            "blocks": F.ceil(F.col("source_rows") / F.lit(BLOCK_ROWS)).cast("long"),
        }
    )


def mix_sources(
    docs: DataFrame, entropy: float = 0.98, max_repeats: float = 2.0, budget: int | None = None, seed: int = 17, tokens: Column | None = None
) -> DataFrame:
    """The mixture's rows: doc_id, source, tokens, weight, budget, epoch, block, position, rows of a source repeated by epoch."""
    spread = F.when(F.col("doc_id").isNull(), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
    rows = docs.select("doc_id", "source", (tokens if tokens is not None else count_words()).alias("tokens"), spread.alias("spread"))
    rows = materialise(rows.withColumn("source_key", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))), "mixing-rows")
    plan = source_plan(rows, entropy, max_repeats, budget)
    dealt = (
        rows.join(plan, "source_key")
        .withColumn("epoch", F.explode(F.expr("sequence(0, if(rest > 0, epochs, epochs - 1))")))
        .withColumn("block", _md5_long(F.lit(seed), F.lit("block"), F.coalesce(F.col("doc_id").cast("string"), "spread")) % F.col("blocks"))
    )
    dealt = dealt.filter("rest > 0 or epochs > 0")
    key = ["source_key", "epoch", "block"]
    block_hash = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"), F.col("source_key"), F.col("block").cast("string")).cast("binary"))
    blocks = dealt.groupBy(*key).agg(F.sum("tokens").alias("block_tokens"))
    before = Window.partitionBy("source_key", "epoch").orderBy(block_hash, "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("block_start", F.coalesce(F.sum("block_tokens").over(before), F.lit(0))).drop("block_tokens")
    row_hash = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    within = Window.partitionBy(*key).orderBy(row_hash, "doc_id", "tokens", "spread").rowsBetween(Window.unboundedPreceding, -1)
    # Blocks of the partial epoch that begin beyond its tokens need no rows; a block holds about BLOCK_ROWS rows.
    placed = dealt.join(blocks, key).filter("epoch < epochs or block_start < rest")
    placed = placed.withColumn("start", F.col("block_start") + F.coalesce(F.sum("tokens").over(within), F.lit(0))).filter("epoch < epochs or start < rest")
    position = F.when(F.col("budget") > 0, (F.col("epoch") * F.col("source_tokens") + F.col("start")) / F.col("budget")).otherwise(F.lit(0.0))
    return placed.select(
        "doc_id", "source", "tokens", F.round("weight", 9).alias("weight"), "budget", "epoch", "block", F.round(position, 9).alias("position")
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """docs themselves in the mixture: a row appears once for every epoch that takes it (doc_id must tell rows apart)."""
    times = mix_sources(docs, **settings).groupBy("doc_id").agg(F.count("*").alias("times"))
    # Rows sharing a doc_id are each repeated as often as all of them together, divided by their number.
    copies = docs.groupBy("doc_id").agg(F.count("*").alias("copies"))
    key, n, k = (unused(docs, c) for c in ("mix_id", "mix_times", "mix_epoch"))
    each = times.join(copies, times["doc_id"].eqNullSafe(copies["doc_id"])).select(times["doc_id"].alias(key), F.expr("cast(ceil(times / copies) as int)").alias(n))
    joined = docs.join(each, docs["doc_id"].eqNullSafe(each[key]))
    return joined.withColumn(k, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*[docs[c] for c in docs.columns])
