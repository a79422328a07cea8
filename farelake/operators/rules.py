"""Column rules of the gold tables: values that must be present, and text of limited length."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    required: bool = False
    length: int | None = None

    def broken(self, name: str) -> Column:
        value = F.col(name)
        broken = value.isNull() if self.required else F.lit(False)
        return broken | F.coalesce(F.length(value.cast("string")) > self.length, F.lit(False)) if self.length else broken


# The rules of the tables' definitions.
GOLD_RULES: dict[str, dict[str, Rule]] = {
    "fct_trips": {"pickup_date_key": Rule(required=True), "service_type": Rule(length=10), "store_and_fwd_flag": Rule(length=1),
                  "source_month": Rule(length=10)},
    "dim_zone": {"zone_key": Rule(required=True)},
    "dim_service_type": {"service_type": Rule(required=True)},
    "dim_payment_type": {"payment_type_id": Rule(required=True), "payment_type": Rule(required=True, length=10)},
}


def violations(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """(column_name, violations) of each rule, from one aggregate."""
    counts = df.agg(*(F.count_if(rule.broken(name)).alias(name) for name, rule in rules.items()))
    entries = F.array(*(F.struct(F.lit(name).alias("column_name"), F.col(name).alias("violations")) for name in rules))
    return counts.select(F.explode(entries).alias("entry")).select("entry.*")


def enforced(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """The same rows; a value that breaks a rule fails the writing job."""
    kinds = dict(df.dtypes)

    def checked(name: str, rule: Rule) -> Column:
        message = F.concat(F.lit(f"column rule of {name} broken by "), F.coalesce(F.col(name).cast("string"), F.lit("NULL")))
        return F.when(~rule.broken(name), F.col(name)).otherwise(F.raise_error(message).cast(kinds[name]))

    return df.withColumns({name: checked(name, rule) for name, rule in rules.items() if name in df.columns})
