"""Salts for heavy cards, from mergeable heavy-hitter sketches.

``card_sketches`` counts cards approximately (Spark's frequent-items sketch): one
sketch for each group, such as a day, that can be stored and merged. ``card_salts``
merges them and gives every card with more than a ``spread``-th of the rows as
many sub-keys as it has such shares. A sketch's counts may be somewhat too
high; the alerts don't depend on them, only how evenly the work is dealt.

The salts are a small table, at most ``most_cards`` rows, and are joined by
broadcast. Cards not in it keep one sub-key, so nothing else is copied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def card_sketches(transactions: DataFrame, by: str | None = None, tracked: int = 20_000) -> DataFrame:
    """(by, rows, sketch): how often cards occur in each group of ``by``, or in all."""
    groups = [by] if by else []
    # rows without a card match nothing: they don't count
    return transactions.groupBy(*groups).agg(F.count("card_number").alias("rows"), F.expr(f"approx_top_k_accumulate(card_number, {tracked})").alias("sketch"))


def card_salts(sketches: DataFrame, spread: int = 1000, most_cards: int = 10_000, tracked: int = 20_000) -> DataFrame:
    """(card_number, salts) of the cards with more than a ``spread``-th of all rows; there are fewer than ``spread`` of these."""
    # grouped, by a constant: combining fails in a task that has no sketch to combine
    merged = sketches.groupBy(F.lit(0).alias("_all")).agg(F.sum("rows").alias("total"), F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {min(spread, most_cards)})").alias("top"))
    cards = merged.select("total", F.explode("top").alias("t")).select(F.col("t.item").alias("card_number"), F.col("t.count").alias("n"), "total")
    share = F.ceil(F.try_divide(F.col("n") * spread, F.col("total"))).cast("int")
    return cards.filter((F.col("n") * spread > F.col("total")) & F.col("card_number").isNotNull()).select("card_number", F.least(share, F.lit(spread)).alias("salts"))
