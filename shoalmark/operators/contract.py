"""Rules a source has to meet before it is loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import blank_to_null

# The sales contract and its key columns.
SALES_COLUMNS = ["order_id", "customer_id", "amount", "country", "ingestion_date"]
SALES_TYPES = {
    "order_id": "string",
    "customer_id": "string",
    "amount": "double",
    "country": "string",
    "ingestion_date": "date",
}
SALES_KEYS = ["order_id", "customer_id"]


def contract_violations(rows: DataFrame, types: dict[str, str], keys: list[str]) -> DataFrame:
    """``column_name, uncastable, null_keys`` for text rows, from one aggregate over all rows."""
    counts = []
    for name, t in types.items():
        cell = blank_to_null(F.col(name).cast("string"))
        bad = F.count_if(cell.isNotNull() & cell.try_cast(t).isNull())
        empty = F.count_if(cell.isNull()) if name in keys else F.lit(0).cast("bigint")
        counts.append(
            F.struct(
                F.lit(name).alias("column_name"),
                bad.alias("uncastable"),
                empty.alias("null_keys"),
            )
        )
    return rows.agg(F.array(*counts).alias("c")).select(F.inline("c"))
