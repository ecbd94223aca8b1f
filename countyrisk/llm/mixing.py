"""Temperature mixing of sources to target weights.

Each source's share of all words is raised to one exponent and normalised. The exponent, in
[0, 1], is bisected (32 parts at a time, each step one small aggregation) to the smallest one
whose weights have at most the target entropy and repeat no source more often than allowed.

The weights are realised as budgets of words over permutations of blocks. A source is cut
into blocks by a hash of the document id; an epoch goes through all blocks in a hashed order,
and through each block in a hashed order. A source takes as many whole epochs as its budget
pays for, then whole blocks of the next epoch, then documents of the block where the budget
ends. So only one row per source decides over every document, no source is ever ordered in
one task, and the texts aren't shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lengths import with_lengths, written

BLOCK_ROWS = 4_096
TARGET_ENTROPY = 0.98
MAX_REPEATS = 4.0


def source_key(column: str = "source"):
    """Null is a source of its own."""
    return F.coalesce(F.concat(F.lit("s"), F.col(column).cast("string")), F.lit("n"))


def find_exponent(totals: DataFrame, budget: int, target_entropy: float, max_repeats: float) -> float:
    """Smallest exponent in [0, 1] that meets both bounds, to about 1e-6; 1 if none does.

    ``totals`` has ``words`` > 0 of each source; ``target_entropy`` is a share of the largest
    possible entropy, that of equal weights."""
    whole, kinds = totals.agg(F.sum("words"), F.count("*")).first()
    if not whole or kinds < 2:
        return 1.0
    if budget > max_repeats * whole:
        raise ValueError("the budget asks for more repeats than are allowed")
    most = target_entropy * math.log(kinds)

    def meets(exponents: list[float]) -> list[bool]:
        share = F.col("words") / F.lit(float(whole))
        raised = F.exp(F.col("exponent") * F.log(share))
        rows = (
            totals.select("words", F.explode(F.array(*map(F.lit, exponents))).alias("exponent"))
            .groupBy("exponent")
            .agg(F.sum(raised).alias("z"), F.sum(raised * F.log(raised)).alias("s"), F.max(raised / share).alias("top"))
            .collect()
        )
        good = {r["exponent"]: math.log(r["z"]) - r["s"] / r["z"] <= most + 1e-12 and budget / whole * r["top"] / r["z"] <= max_repeats + 1e-12 for r in rows}
        return [good[x] for x in exponents]

    low, high = 0.0, 1.0
    if meets([low])[0]:
        return low
    for _ in range(4):
        steps = [low + (high - low) * k / 32 for k in range(1, 32)]
        found = meets(steps)
        first = next((k for k, ok in enumerate(found) if ok), len(steps))
        low, high = (steps[first - 1] if first else low), (steps[first] if first < len(steps) else high)
    return round(high, 6)


def block_order(seed: int):
    """Places of a document in the order of an epoch: its block's, then its own."""
    block = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed)), F.col("blocks"))
    own = F.xxhash64("doc_id", "text_hash", F.col("epochs"), F.lit(seed + 1))
    return block, F.xxhash64("key", block, F.col("epochs"), F.lit(seed)), own


def mixing_decisions(
    docs: DataFrame, budget: int | None, target_entropy: float, max_repeats: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, text_hash, key, n_words`` of every row, one row per source with its decisions)."""
    rows = written(with_lengths(docs).select("doc_id", "text_hash", source_key().alias("key"), "n_words"), "mixing-rows")
    totals = written(rows.groupBy("key").agg(F.sum("n_words").alias("words"), F.count("*").alias("rows")), "mixing-totals")
    paid = totals.where("words > 0")
    whole = paid.agg(F.sum("words")).first()[0] or 0
    budget = whole if budget is None else budget
    exponent = find_exponent(paid, budget, target_entropy, max_repeats)
    raised = F.pow(F.col("words") / F.lit(float(max(whole, 1))), F.lit(exponent))
    scale = paid.agg(F.sum(raised)).first()[0] or 1.0
    plan = totals.select(
        "key",
        "words",
        F.greatest(F.lit(1), F.ceil(F.col("rows") / BLOCK_ROWS)).cast("long").alias("blocks"),
        F.when(F.col("words") > 0, F.round(raised / F.lit(scale), 12)).otherwise(0.0).alias("weight"),
        F.lit(exponent).alias("exponent"),
    )
    share = F.round(F.col("weight") * F.lit(budget)).cast("long")
    plan = plan.withColumn("epochs", F.when(F.col("words") > 0, F.floor(share / F.col("words"))).otherwise(0).cast("long"))
    plan = written(plan.withColumn("rest", share - F.col("epochs") * F.col("words")), "mixing-plan")

    block, place, own = block_order(seed)
    placed = rows.join(plan.where("rest > 0").select("key", "blocks", "epochs", "rest"), "key").select(
        "key", "doc_id", "n_words", "rest", block.alias("block"), place.alias("place"), own.alias("own")
    )
    sums = placed.groupBy("key", "rest", "place", "block").agg(F.sum("n_words").alias("words"))
    before = F.sum("words").over(Window.partitionBy("key").orderBy("place", "block")) - F.col("words")
    # the block where the budget ends: all blocks before it are taken whole
    ends = sums.withColumn("before", before).where("before <= rest AND before + words > rest")
    ends = ends.select("key", F.col("place").alias("end_place"), F.col("block").alias("end_block"), (F.col("rest") - F.col("before")).alias("left"))
    last = placed.join(ends, "key").where("place = end_place AND block = end_block")
    # rows of one id and text go together, as one sum
    last = last.groupBy("key", "left", "own").agg(F.sum("n_words").alias("n_words"))
    upto = F.sum("n_words").over(Window.partitionBy("key").orderBy("own").rangeBetween(Window.unboundedPreceding, 0))
    cut = last.withColumn("upto", upto).where("upto <= left").groupBy("key").agg(F.max("own").alias("end_own"))
    return rows, written(plan.join(ends.drop("left"), "key", "left").join(cut, "key", "left"), "mixing-decisions")


def with_copies(rows: DataFrame, decisions: DataFrame, seed: int) -> DataFrame:
    """``rows`` (with ``key``, ``doc_id`` and ``text_hash``) and ``copies``, ``weight``, ``exponent``."""
    chosen = decisions.select("key", "blocks", "epochs", "end_place", "end_block", "end_own", "weight", "exponent")
    block, place, own = block_order(seed)
    earlier = (place < F.col("end_place")) | ((place == F.col("end_place")) & (block < F.col("end_block")))
    inside = (place == F.col("end_place")) & (block == F.col("end_block")) & (own <= F.col("end_own"))
    copies = F.col("epochs") + F.coalesce(earlier | inside, F.lit(False)).cast("long")
    return rows.join(chosen, "key").withColumn("copies", copies).drop("blocks", "epochs", "end_place", "end_block", "end_own")


def mixing_plan(
    docs: DataFrame, budget: int | None = None, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS, seed: int = 7
) -> DataFrame:
    """``doc_id, source, n_words, copies, weight, exponent`` of every row of ``docs``.

    ``budget`` is in words; by default as many as there are. A null source is a source of its
    own; one without words has weight 0. Null and empty texts have no words and come with the
    block they stand in. Rows without an id are dealt by their text like any other; rows alike in id and
    text are taken together; other columns are left out; an empty table gives no rows."""
    rows, decisions = mixing_decisions(docs, budget, target_entropy, max_repeats, seed)
    source = F.when(F.col("key") != "n", F.expr("substring(key, 2)"))
    return with_copies(rows, decisions, seed).select("doc_id", source.alias("source"), "n_words", "copies", "weight", "exponent")


def mix_sources(
    docs: DataFrame, budget: int | None = None, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS, seed: int = 7
) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it, in the same columns."""
    _, decisions = mixing_decisions(docs, budget, target_entropy, max_repeats, seed)
    inner = docs.select(F.struct(*docs.columns).alias("row"), source_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    mixed = with_copies(inner, decisions, seed).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
