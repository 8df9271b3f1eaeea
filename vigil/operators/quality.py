"""Data-quality expectations: drop or warn, quarantine, per-rule counts.

An expectation is a SQL condition. ``drop`` removes rows for which it is not
true (null counts as a failure), ``warn`` keeps them and only counts. Counting
uses ``observe`` (batch and streaming: per micro-batch in the progress) or a
plain aggregate (``expectation_report``); both are single-pass, partial
aggregates with no shuffle of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    condition: str
    action: str = "drop"          # "drop" | "warn"

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


# Silver transactions: four keys must be present, amounts should be positive.
TRANSACTION_EXPECTATIONS = (
    Expectation("valid_transaction_id", "transaction_id IS NOT NULL"),
    Expectation("valid_customer_id", "customer_id IS NOT NULL"),
    Expectation("valid_card_number", "card_number IS NOT NULL"),
    Expectation("valid_merchant_id", "merchant_id IS NOT NULL"),
    Expectation("valid_amount", "amount > 0", "warn"),
)

# Silver customers: the key must be present.
CUSTOMER_EXPECTATIONS = (
    Expectation("valid_customer_id", "customer_id IS NOT NULL"),
)


# Silver watchlist: nothing is dropped; what can't be matched or dated is counted.
WATCHLIST_EXPECTATIONS = (
    Expectation("valid_watchlist_id", "watchlist_id IS NOT NULL", "warn"),
    Expectation("valid_entity_id", "entity_id IS NOT NULL", "warn"),
    Expectation("valid_effective_from", "effective_from IS NOT NULL", "warn"),
    Expectation("known_risk_level", "risk_level IN ('HIGH', 'MEDIUM', 'LOW')", "warn"),
)


def _drop_rules(expectations) -> list[Expectation]:
    return [e for e in expectations if e.action == "drop"]


def keep_valid(df: DataFrame, expectations=TRANSACTION_EXPECTATIONS) -> DataFrame:
    """Rows that pass every ``drop`` expectation."""
    cond = F.lit(True)
    for e in _drop_rules(expectations):
        cond = cond & e.passed()
    return df.filter(cond)


def failed_rules(df: DataFrame, expectations=TRANSACTION_EXPECTATIONS) -> DataFrame:
    """All rows, with the names of the ``drop`` expectations that each fails."""
    failed = F.filter(
        F.array(*[F.when(~e.passed(), F.lit(e.name)) for e in _drop_rules(expectations)]),
        lambda x: x.isNotNull())
    return df.withColumn("failed_expectations", failed)


def quarantine(df: DataFrame, expectations=TRANSACTION_EXPECTATIONS) -> DataFrame:
    """Rows that fail at least one ``drop`` expectation, with the failed names."""
    return failed_rules(df, expectations).filter(F.size("failed_expectations") > 0)


def observe_expectations(df: DataFrame, name: str, expectations=TRANSACTION_EXPECTATIONS):
    """Attach per-rule failure counts as observed metrics.

    Returns ``(observed_df, observation)``; for a batch frame read
    ``observation.get`` after an action, for a stream read
    ``query.lastProgress['observedMetrics'][name]``.
    """
    from pyspark.sql import Observation

    metrics = [F.count_if(~e.passed()).alias(e.name) for e in expectations]
    metrics.append(F.count(F.lit(1)).alias("total_records"))
    if df.isStreaming:
        return df.observe(name, *metrics), None
    obs = Observation(name)
    return df.observe(obs, *metrics), obs


def expect(df: DataFrame, name: str, expectations=TRANSACTION_EXPECTATIONS):
    """Observe all rules, then drop the rows failing a ``drop`` rule."""
    observed, obs = observe_expectations(df, name, expectations)
    return keep_valid(observed, expectations), obs


def expectation_report(df: DataFrame, expectations=TRANSACTION_EXPECTATIONS) -> DataFrame:
    """One row per expectation: name, action, failed and total record counts."""
    aggs = [F.count_if(~e.passed()).alias(f"_f{i}") for i, e in enumerate(expectations)]
    counts = df.agg(F.count(F.lit(1)).alias("total_records"), *aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(e.name).alias("expectation"), F.lit(e.action).alias("action"),
                 F.col(f"_f{i}").alias("failed_records"))
        for i, e in enumerate(expectations)]))
    return counts.select(rows.alias("r"), "total_records").select("r.*", "total_records")


def quarantine_messages(bronze: DataFrame, expectations=TRANSACTION_EXPECTATIONS,
                        schema=None) -> DataFrame:
    """Raw messages that fail a ``drop`` expectation, kept for replay: key,
    value (the text as received), topic, partition, offset, timestamp and the
    failed rule names. Only the fields the drop rules read are parsed."""
    import re

    from pyspark.sql.types import StructType

    if schema is None:
        from vigil.schemas import TRANSACTION_SCHEMA as schema
    rules = _drop_rules(expectations)
    needed = StructType([f for f in schema.fields
                         if any(re.search(rf"\b{re.escape(f.name)}\b", e.condition) for e in rules)])
    raw = ["key", "value", "topic", "partition", "offset", "timestamp"]
    # a generator, as a filter moved below a projection would parse the text once for each rule
    parsed = bronze.select(*raw, F.inline_outer(F.array(F.from_json(F.col("value"), needed))))
    return quarantine(parsed, rules).select(*raw, "failed_expectations")
