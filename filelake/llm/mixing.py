"""Temperature mixing: source weights by exponent, realised as budgeted permutations of blocks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filelake.llm import scratch

# Documents of a source that are ordered together; blocks are ordered among themselves.
BLOCK = 10_000
SEED = 17
# Exponents tried in one pass over the sources: as many halvings at once as make this number.
TRIES = 31
PASSES = 9


def words(text: Column) -> Column:
    """Words of a text, counted by spaces and line ends; 0 for null and for empty texts."""
    bare = F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))
    counted = F.octet_length(text) - F.octet_length(bare) + 1
    return F.when(F.octet_length(text) > 0, counted).otherwise(0).cast("long")


def _source(source: Column) -> Column:
    """Sources as strings without null: a null source is one of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def exponent(
    sources: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None, budget: float | None = None
) -> float:
    """The exponent for token shares ``sources (tokens)``, by bisection.

    Weights are shares to this power, normalised; 1 keeps the shares, 0 makes sources equal. Entropy (as a
    part of the largest possible, the logarithm of the number of sources) falls and repetition rises the
    further it is from 1. The result is the largest exponent in [0, 1] that reaches ``target_entropy``, or if
    a smaller source would then be repeated more than ``max_repetition`` times, the smallest that keeps
    this limit. With neither, it is 1. Repetition is that under ``budget`` tokens, or where it is None
    under the smallest budget that gives every document once. One aggregate tries ``TRIES`` exponents.
    """
    used = sources.filter("tokens > 0")
    n, total, most = used.agg(F.count("*"), F.sum("tokens"), F.max("tokens")).first()
    if not n:
        return 1.0
    # Shares of the largest source's, so that powers stay in range.
    part = F.col("tokens") / F.lit(float(most))

    def search(fits) -> float:
        """Largest exponent with ``fits``, which holds from 0 up to some point."""
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            tries = [low + (high - low) * i / TRIES for i in range(1, TRIES + 1)]
            sums = []
            for a in tries:
                power = F.pow(part, F.lit(a))
                sums += [F.sum(power), F.sum(power * F.ln(part)), F.max(F.pow(part, F.lit(a - 1)))]
            row = used.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
            good = [a for i, a in enumerate(tries) if fits(a, *row[3 * i : 3 * i + 3])]
            best = max(good, default=low)
            if best == high:
                return high
            low, high = best, min(a for a in tries if a > best)
        return low

    def entropy_met(a: float, z: float, zl: float, _: float) -> bool:
        return (math.log(z) - a * zl / z) >= target_entropy * math.log(n) - 1e-12

    def repeated(a: float, z: float, _: float, smallest: float) -> float:
        own = total / most
        return (budget / total if budget else z / own) * own / z * smallest

    found = 1.0
    if target_entropy is not None and n > 1:
        found = search(entropy_met)
    if max_repetition is not None:
        # Repetition falls towards 1, so the limit holds from some exponent on; search the failing side.
        worst = used.agg(F.sum(F.pow(part, F.lit(found))), F.max(F.pow(part, F.lit(found - 1)))).first()
        if repeated(found, worst[0], 0.0, worst[1]) > max_repetition:
            found = max(found, search(lambda a, z, zl, s: repeated(a, z, zl, s) > max_repetition))
    return found


def plan(
    docs: DataFrame, id_col: str, source_col: str, tokens: Column, text_col: str | None,
    target_entropy: float | None, max_repetition: float | None, budget: float | None, seed: int, block: int,
) -> DataFrame:
    """``(_id, _text, _source, tokens, pass, at, place)``: every use of a document in the mixture."""
    text = F.xxhash64(text_col) if text_col else F.lit(0).cast("long")
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("_id"), text.alias("_text"),
        _source(F.col(source_col)).alias("_source"), tokens.cast("long").alias("tokens"),
    )
    # Rows that repeat id, text and source are one document with the tokens of all.
    rows, _ = scratch.put(
        rows.groupBy("_id", "_text", "_source").agg(F.sum(F.coalesce("tokens", F.lit(0))).alias("tokens")), "mix-rows"
    )
    sources, _ = scratch.put(
        rows.groupBy("_source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "mix-sources"
    )
    power = exponent(sources, target_entropy, max_repetition, budget)
    used = sources.filter("tokens > 0")
    total, most = used.agg(F.sum("tokens"), F.max("tokens")).first()
    total, most = float(total or 1), float(most or 1)
    part = F.col("tokens") / F.lit(most)
    z = used.agg(F.sum(F.pow(part, F.lit(power)))).first()[0] or 1.0
    spent = budget if budget else most * z
    weighted = sources.select(
        "_source", F.col("tokens").alias("_all"),
        F.ceil(F.col("docs") / F.lit(block)).alias("_blocks"),
        # A source without tokens is used once: its documents cost nothing.
        F.when(F.col("tokens") > 0, F.lit(spent / z) * F.pow(part, F.lit(power))).otherwise(0.0).alias("_budget"),
    ).withColumns({
        "_full": F.when(F.col("_all") > 0, F.floor(F.col("_budget") / F.col("_all") + F.lit(1e-9))).otherwise(1),
    }).withColumn("_rest", F.greatest(F.col("_budget") - F.col("_full") * F.col("_all"), F.lit(0.0)))
    placed = rows.join(weighted, "_source").withColumn(
        "_block", F.pmod(F.xxhash64("_id", "_text", F.lit(seed)), F.col("_blocks"))
    )
    blocks = placed.groupBy("_source", "_block").agg(
        F.sum("tokens").alias("_in_block"), F.first("_full").alias("_full"), F.first("_rest").alias("_rest")
    )
    # The order of the blocks is drawn anew for every pass, the last of which may be partial.
    order = F.xxhash64("_source", "_block", "pass", F.lit(seed))
    passes = blocks.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("_full").cast("int"))))
    by_pass = Window.partitionBy("_source", "pass").orderBy(order, "_block")
    passes = passes.withColumn(
        "_before", F.sum("_in_block").over(by_pass.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_in_block")
    ).filter((F.col("pass") < F.col("_full")) | (F.col("_before") < F.col("_rest")))
    passes, _ = scratch.put(passes.select("_source", "_block", "pass", "_before"), "mix-blocks")
    uses = placed.join(passes, ["_source", "_block"])
    by_block = Window.partitionBy("_source", "_block", "pass").orderBy(F.xxhash64("_id", "_text", "pass", F.lit(seed)), "_id", "_text")
    at = F.col("_before") + F.sum("tokens").over(by_block.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")
    uses = uses.withColumn("_at", at).filter(
        (F.col("pass") < F.col("_full")) | (F.col("_at") + F.col("tokens") <= F.col("_rest"))
    )
    at = F.col("pass") * F.col("_all") + F.col("_at")
    # Sources advance together: each is at the same part of its own budget.
    return uses.select(
        "_id", "_text", "_source", "tokens", "pass", at.cast("long").alias("at"),
        (at / F.greatest("_budget", F.lit(1.0))).alias("place"),
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    target_entropy: float | None = None, max_repetition: float | None = None, budget: float | None = None,
    seed: int = SEED, block: int = BLOCK,
) -> DataFrame:
    """``docs``, each row as often as the mixture uses it, with ``pass`` and ``place``.

    Sources get weights of their token shares (words, see ``words``) to the power of ``exponent``; a source's
    budget is its weight of ``budget`` tokens. It is spent in whole passes over the source and a partial one;
    in each pass the source's blocks are in a new random order and the documents of a block too, and the
    partial pass takes documents in this order as long as they fit. ``place`` (0 to 1) is how much of the
    source's budget lies before a document: sorted by it, the mixture has the target weights everywhere.
    Without ``budget`` it is the smallest that uses every document at least once, so nothing is left out;
    with a smaller one, large sources are used in part.

    A null source is a source of its own. Null and empty texts have no tokens: they are used in every pass
    of their source, and once if it has no tokens at all. Null ids are kept. Rows that repeat id, text and source are
    used together. No rows give no rows. ``pass`` and ``place`` replace columns of these names.
    """
    uses = plan(
        docs, id_col, source_col, words(F.col(text_col)), text_col, target_entropy, max_repetition, budget, seed, block
    ).select(
        F.col("_id").alias("__id"), F.col("_text").alias("__text"), F.col("_source").alias("__source"),
        F.col("pass").alias("__pass"), F.col("place").alias("__place"),
    )
    own = {
        "__id": F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)), "__text": F.xxhash64(text_col),
        "__source": _source(F.col(source_col)),
    }
    joined = docs.withColumns(own).join(uses, list(own))
    return joined.withColumns({"pass": F.col("__pass"), "place": F.col("__place")}).drop(*own, "__pass", "__place")
