"""Table and stream operators for PySpark: every operator takes and returns DataFrames."""

__version__ = "0.1.0"
