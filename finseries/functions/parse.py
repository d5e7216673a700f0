"""Column parsers: lenient numbers, strict dates, percent text.

All are built-in Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A plain decimal or scientific number with optional sign and surrounding
# blanks.  Spark's own cast would also take "1.5d" or "0x1p3"; those count
# as bad text here.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITY_PATTERN = r"^\s*[+-]?(?i)(inf|infinity)\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c) -> Column:
    """Text to DOUBLE; bad text, blanks and NaN become NULL, never an error."""
    c = _col(c).cast("string")
    ok = c.rlike(NUMBER_PATTERN) | c.rlike(INFINITY_PATTERN)
    parsed = F.trim(c).try_cast("double")
    return F.when(ok & ~F.isnan(parsed), parsed)


def nan_to_null(c) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def numbers(df: DataFrame) -> DataFrame:
    """``df`` with NaN as NULL in its float and double columns, as in the source's missing values."""
    fix = {f.name: nan_to_null(f.name) for f in df.schema.fields if f.dataType.typeName() in ("float", "double")}
    return df.withColumns(fix) if fix else df


def percent_to_number(c) -> Column:
    """``"12.5%"`` to 12.5: the percent sign is removed literally, then parsed."""
    return to_number(F.replace(_col(c).cast("string"), F.lit("%"), F.lit("")))


def strict_date(c) -> Column:
    """Text to DATE; text that is not a date raises, NULL stays NULL."""
    c = _col(c)
    parsed = c.cast("string").try_cast("date")
    return F.when(c.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("not a date: "), c.cast("string")))
                  ).otherwise(parsed).cast("date")
