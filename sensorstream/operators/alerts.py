"""Alert labelling: first broken rule, every broken rule, table, messages.

All of it is native Catalyst expressions over the rule table; nothing runs in
Python on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalise import measure
from ..functions.time import display_time
from ..rules import RULES, Rule
from ..schema import ENRICHED_COLUMNS


def rule_condition(rule: Rule) -> Column:
    """Strict comparison on a NaN-guarded measurement (null breaks no rule)."""
    v = measure(rule.column)
    t = F.lit(rule.threshold)
    if rule.op == ">":
        return v > t
    if rule.op == "<":
        return v < t
    if rule.op == "==":
        return v == t
    raise ValueError(rule.op)


def first_alert(df: DataFrame, rules: Sequence[Rule] = RULES, enriched_only: bool = False) -> DataFrame:
    """Add ``alert_type`` (code of the first broken rule) and ``alert_value``
    (that rule's measurement as text).

    Each condition is stated once: one CASE yields a (code, value) struct.
    With ``enriched_only`` the nine archive columns are returned, in order.
    """
    hit = None
    for r in rules:
        val = F.struct(F.lit(r.code).alias("code"), F.col(r.column).cast("string").alias("value"))
        hit = F.when(rule_condition(r), val) if hit is None else hit.when(rule_condition(r), val)
    out = df.withColumn("_hit", hit).withColumns(
        {"alert_type": F.col("_hit.code"), "alert_value": F.col("_hit.value")}
    ).drop("_hit")
    if enriched_only:
        return out.select(*ENRICHED_COLUMNS)
    return out


def all_alerts(df: DataFrame, rules: Sequence[Rule] = RULES, column: str = "alert_list") -> DataFrame:
    """Add the list of every broken rule's label, in rule order; null when none."""
    labels = F.array_compact(F.array(*[F.when(rule_condition(r), F.lit(r.label)) for r in rules]))
    return df.withColumn(column, F.when(F.size(labels) > 0, labels))


def explode_alerts(df: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per (reading, broken rule) with the label in ``alert_type``.

    Readings breaking no rule produce no row.
    """
    with_list = all_alerts(df, rules, "_alerts")
    keep = [c for c in df.columns if c != "alert_type"]
    return with_list.select(*keep, F.explode("_alerts").alias("alert_type"))


def alert_table(enriched: DataFrame) -> DataFrame:
    """Display rows for alerting readings: Timestamp (HH:mm:ss), Sensor,
    Alert Type, Value."""
    return enriched.filter(F.col("alert_type").isNotNull()).select(
        display_time("timestamp").alias("Timestamp"),
        F.col("sensor_id").alias("Sensor"),
        F.col("alert_type").alias("Alert Type"),
        F.col("alert_value").alias("Value"),
    )


def alert_message(code: Column, sensor: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Notification text for an alert code; unknown code -> null."""
    msg = None
    for r in rules:
        pre, post = r.message.split("{sensor}")
        text = F.concat(F.lit(pre), F.coalesce(sensor, F.lit("None")), F.lit(post))
        msg = F.when(code == F.lit(r.code), text) if msg is None else msg.when(code == F.lit(r.code), text)
    return msg


def alert_messages(enriched: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One notification per alerting reading (delivery is the caller's sink)."""
    return enriched.filter(F.col("alert_type").isNotNull()).select(
        *keep, "sensor_id", "alert_type",
        alert_message(F.col("alert_type"), F.col("sensor_id")).alias("message"),
    )


def alert_counts(enriched: DataFrame) -> DataFrame:
    """Readings per first-match code (null code = no alert)."""
    return enriched.groupBy("alert_type").agg(F.count(F.lit(1)).alias("n_readings"))
