"""Physical layout: compaction, clustering, partition reports and caching."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from math import ceil, inf, log2

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.project import spread
from millrace.sources.readers import file_of_row, file_sizes


def partition_report(df: DataFrame) -> DataFrame:
    """Rows per physical partition that has any: shows skew."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def partition_summary(df: DataFrame) -> DataFrame:
    """One row: partitions that have rows, rows of the smallest and the largest, and all rows."""
    return partition_report(df).agg(
        F.count(F.lit(1)).alias("partitions"), F.coalesce(F.min("rows"), F.lit(0)).alias("least"),
        F.coalesce(F.max("rows"), F.lit(0)).alias("most"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


def partition_count(df: DataFrame) -> int:
    """Number of physical partitions of a batch frame."""
    return df.rdd.getNumPartitions()


def target_files(spark: SparkSession, path: str, target_bytes: int) -> int:
    """How many files of ``target_bytes`` the data below ``path`` fills."""
    found = file_sizes(spark, path).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("total")).first()
    if not found.files:
        raise ValueError(f"no data files below {path}")
    return max(1, ceil(found.total / target_bytes))


def compact(spark: SparkSession, path: str, new_path: str, target_bytes: int = 256 << 20,
            partition_by: Sequence[str] = ()) -> DataFrame:
    """Rewrite many small Parquet files as few large ones at a new path.

    Scans already pack small files into tasks of even size, so whole tasks are
    merged and nothing is shuffled. With partition columns the rebalance hint
    gathers each folder and lets adaptive execution cut large folders and merge
    small tasks.
    """
    df = spark.read.parquet(path)
    if partition_by:
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(new_path)
    else:
        df.coalesce(target_files(spark, path, target_bytes)).write.parquet(new_path)
    return spark.read.parquet(new_path)


def _as_number(column: Column, kind: str) -> Column:
    """An order-preserving number for a column that is not text."""
    if kind.startswith("timestamp") or kind == "date":
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def _text_cuts(df: DataFrame, name: str, slots: int) -> list[str]:
    """Values that cut a text column into about ``slots`` equal parts, compared as whole strings.

    Spark's range partitioning finds them from a sample; they only shape the layout.
    """
    ranged = df.where(F.col(name).isNotNull()).select(name).repartitionByRange(slots, name)
    firsts = ranged.groupBy(F.spark_partition_id()).agg(F.min(name).alias("cut"))
    return sorted(r.cut for r in firsts.collect())[1:]


def _text_slot(column: Column, cuts: list[str], step: int = 32) -> Column:
    """How many cuts a value has reached: every ``step``-th cut first, then those in between."""
    if not cuts:
        return F.lit(0)
    every, coarse = F.array(*[F.lit(c) for c in cuts]), F.array(*[F.lit(c) for c in cuts[::step]])
    blocks = F.size(F.filter(coarse, lambda c: c <= column))
    inside = F.size(F.filter(F.slice(every, F.greatest((blocks - 1) * step + 1, F.lit(1)), F.lit(step)),
                             lambda c: c <= column))
    return F.when(blocks == 0, F.lit(0)).otherwise((blocks - 1) * step + inside)


def z_bits(partitions: int, columns: int) -> int:
    """Bits per column: enough that every partition covers several slots of each column."""
    return max(1, min(ceil(log2(max(2, partitions)) / columns) + 2, 62 // columns, 12))


def with_z_value(df: DataFrame, columns: Sequence[str], name: str, bits: int = 6, accuracy: int = 10_000) -> DataFrame:
    """Add the bit-interleaved position of a row among the quantiles of the columns.

    Quantiles instead of equal widths keep skewed columns useful, and text is
    ranked by its whole value. The driver receives 2**bits - 1 cut points per
    column and nothing else. Unknown values share the last slot.
    """
    if not 1 <= bits * len(columns) <= 62:
        raise ValueError("the interleaved value has to fit 62 bits")
    kinds = dict(df.dtypes)
    slots: dict[str, Column] = {}
    steps = [i / 2 ** bits for i in range(1, 2 ** bits)]
    numbers = {f"_n{i}": _as_number(F.col(c), kinds[c]) for i, c in enumerate(columns) if kinds[c] != "string"}
    numbered = df.withColumns(numbers) if numbers else df
    if numbers:
        found = numbered.agg(*[F.percentile_approx(n, steps, accuracy).alias(n) for n in numbers]).first()
        splits = {n: [-inf, *sorted(set(found[n] or [0.0])), inf] for n in numbers}
        numbered = Bucketizer(splitsArray=list(splits.values()), inputCols=list(numbers),
                              outputCols=[n + "_rank" for n in numbers], handleInvalid="keep").transform(numbered)
        # an unknown value has the bucket after the last and shares the last one here
        slots = {n: F.least(F.col(n + "_rank"), F.lit(float(len(s) - 2))).cast("long") for n, s in splits.items()}
    value = F.lit(0).cast("long")
    for index, column in enumerate(columns):
        if kinds[column] == "string":
            cuts = _text_cuts(df, column, 2 ** bits)
            slot = F.coalesce(_text_slot(F.col(column), cuts), F.lit(len(cuts))).cast("long")
        else:
            slot = slots[f"_n{index}"]
        for bit in range(bits):
            one = F.shiftright(slot, bit).bitwiseAND(F.lit(1))
            value = value.bitwiseOR(F.shiftleft(one, bit * len(columns) + index))
    return numbered.withColumn(name, value).drop(*numbers, *[n + "_rank" for n in numbers])


def zorder(df: DataFrame, columns: Sequence[str], partitions: int | None = None, bits: int | None = None) -> DataFrame:
    """Cluster rows so that each partition covers a small range of all the columns at once.

    One column is a plain range sort. A row hash comes last in the range keys, so
    rows of one hot value, and copies of one row, fill as many partitions as they need.
    """
    count = [partitions] if partitions else []
    order = list(columns)
    marked = df.withColumn("_tie", spread(df))
    bits = bits or z_bits(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(columns))
    if len(columns) > 1:
        marked = with_z_value(marked, columns, "_z", bits)
        order = ["_z", *columns]
    return (marked.repartitionByRange(*count, *order, "_tie").sortWithinPartitions(*order)
            .drop("_z", "_tie"))


def write_file_index(spark: SparkSession, path: str, columns: Sequence[str], index: str) -> DataFrame:
    """Store, for each file below ``path``, its rows and the minimum, maximum and null count of some columns.

    One pass that reads these columns only; files become groups, so little is shuffled.
    Not-a-number counts as larger than any number, as in Spark's order.
    """
    facts = [f(F.col(c)).alias(f"{name}_{c}") for c in columns
             for name, f in (("low", F.min), ("high", F.max), ("nulls", lambda col: F.count(F.when(col.isNull(), 1))))]
    found = spark.read.parquet(path).select(file_of_row().alias("_file"), *columns)
    found.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"), *facts).write.mode("overwrite").parquet(index)
    return spark.read.parquet(index)


def files_in_range(spark: SparkSession, path: str, index: str, ranges: Mapping[str, tuple]) -> tuple[list[str], int]:
    """Files below ``path`` that may hold rows inside all ``ranges`` (column: lowest, highest; both included), and all files.

    Files that the index does not know are taken along, and files that are gone are left
    out, so an old index costs reads but never rows. Names of files reach the driver,
    which lists them for any scan.
    """
    known = spark.read.parquet(index)
    inside = F.lit(True)
    for column, (low, high) in ranges.items():
        # a file that holds nothing but nulls has no bounds and no row in the range
        inside = inside & F.coalesce((F.col(f"high_{column}") >= F.lit(low)) & (F.col(f"low_{column}") <= F.lit(high)), F.lit(False))
    listed = file_sizes(spark, path).select("path")
    marked = listed.join(known.select(F.col("_file"), inside.alias("_inside")), F.col("path") == F.col("_file"), "left")
    rows = marked.select("path", F.coalesce("_inside", F.lit(True)).alias("open")).collect()
    return sorted(r.path for r in rows if r.open), len(rows)


def scan_range(spark: SparkSession, path: str, index: str, ranges: Mapping[str, tuple]) -> DataFrame:
    """Exactly the rows inside all ``ranges``, from the files whose indexed bounds meet them.

    Files are left out before the scan is planned, unlike by footers, which every task
    has to open first.
    """
    files, _ = files_in_range(spark, path, index, ranges)
    whole = spark.read.parquet(path)
    df = spark.read.schema(whole.schema).option("basePath", path).parquet(*files) if files else whole.limit(0)
    for column, (low, high) in ranges.items():
        df = df.where(F.col(column).between(low, high))
    return df


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` in memory or on disk while the block runs."""
    df.cache()
    try:
        yield df
    finally:
        df.unpersist()
