"""Data-quality checks (DQ-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A rule is SQL text that holds for a good row; NULL counts as failed.
USER_RULES = {"id_not_null": "id IS NOT NULL", "valid_email": "valid_email"}
ITEM_RULES = {"id_not_null": "id IS NOT NULL", "price_positive": "price > 0"}
PURCHASE_RULES = {
    "id_not_null": "id IS NOT NULL",
    "user_id_not_null": "user_id IS NOT NULL",
    "item_id_not_null": "item_id IS NOT NULL",
    "price_positive": "purchase_price > 0",
}


def quality_report(df: DataFrame, table: str, rules: dict[str, str]) -> DataFrame:
    """(table_name, rule, failed, total), all rules counted in one pass over ``df``."""
    failures = [
        F.count(F.when(~F.coalesce(F.expr(rule), F.lit(False)), F.lit(1))).alias(f"_{i}")
        for i, rule in enumerate(rules.values())
    ]
    counts = df.agg(F.count(F.lit(1)).alias("total"), *failures)
    lines = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("failed"))
            for i, name in enumerate(rules)
        ]
    )
    return counts.select("total", F.explode(lines).alias("line")).select(
        F.lit(table).alias("table_name"), "line.rule", "line.failed", "total"
    )
