"""Top movers: clean the all-text movers table, rank by change amount."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finseries.functions import labels
from finseries.functions.parse import percent_to_number, to_number

NUMERIC = ["price", "change_amount", "change_percentage", "volume"]


def type_movers(raw: DataFrame) -> DataFrame:
    """Parse the four numeric columns; bad text becomes NULL.

    ``change_percentage`` loses a literal ``%`` first.
    """
    return raw.select(
        F.col("ticker").cast("string").alias("ticker"),
        to_number("price").alias("price"),
        to_number("change_amount").alias("change_amount"),
        percent_to_number("change_percentage").alias("change_percentage"),
        to_number("volume").alias("volume"),
    )


def clean_movers(raw: DataFrame) -> DataFrame:
    """Typed movers with every row that has a missing number dropped."""
    return type_movers(raw).na.drop(subset=NUMERIC)  # typed numbers are never NaN


def top_movers(movers: DataFrame, k: int = 10, by: str = "change_amount") -> DataFrame:
    """The ``k`` rows with the largest ``by`` (ties by ticker), with percent text.

    ``orderBy(...).limit(k)`` plans as a TakeOrderedAndProject: each task keeps
    its own top ``k`` and only those rows meet in one place.
    """
    return (movers.orderBy(F.desc(by), F.asc("ticker")).limit(k)
            .withColumn("change_percentage_display", labels.percent_text("change_percentage")))
