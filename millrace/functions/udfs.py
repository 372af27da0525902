"""Python functions as columns, for logic that has no built-in expression.

The id extractor also exists as a column expression (``text.extract_id``), which
is the faster choice; these are the three ways to call the same logic in Python.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

#: Segment of the path that holds the id (fixed value).
ID_SEGMENT = 4

# The wrappers below are built on call from local functions: those travel to the
# workers by value, so the package need not be installed there.

def id_udf():
    """Row at a time, carried in Arrow batches."""
    segment = ID_SEGMENT

    def extract(path):
        parts = path.split("/") if path is not None else []
        text = parts[segment] if len(parts) > segment else ""
        return int(text) if text.isascii() and text.isdigit() and int(text) < 2 ** 31 else None
    return F.udf(extract, IntegerType(), useArrow=True)


def id_pandas_udf():
    """A whole column batch at a time."""
    position = ID_SEGMENT

    @F.pandas_udf(IntegerType())
    def extract(paths: pd.Series) -> pd.Series:
        segment = paths.astype("string").str.split("/").str[position].astype("string")
        digits = segment.where(segment.str.fullmatch("[0-9]+", na=False))
        number = pd.to_numeric(digits, errors="coerce")
        return number.where(number < 2 ** 31).astype("Int32")
    return extract


def twice_pandas_udf():
    """Registered by call instead of by decorator; the declared type is what the function returns."""
    def twice(values: pd.Series) -> pd.Series:
        return values * 2.0
    return F.pandas_udf(twice, DoubleType())


def register_for_sql(spark: SparkSession, name: str = "extract_id") -> str:
    """Make the id extractor callable from SQL text."""
    spark.udf.register(name, id_udf())
    return name
