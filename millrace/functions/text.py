"""Text and array functions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Format of the minute key (fixed value).
MINUTE_KEY = "yyyyMMddHHmm"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def split_plain(column: Column | str, separator: str = " ") -> Column:
    """Split at a literal separator; escaped, so that it does not act as a pattern."""
    return F.split(_col(column), re.escape(separator) if separator != " " else separator)


def words(column: Column | str) -> Column:
    """Words between blanks and line ends; empty strings are left out."""
    return F.array_remove(split_plain(F.replace(_col(column), F.lit("\n"), F.lit(" "))), "")


def path_segment(column: Column | str, position: int) -> Column:
    """Segment of a slash-separated path, counted from 0; NULL past the end."""
    return F.get(split_plain(column, "/"), F.lit(position))


def extract_id(column: Column | str, position: int = 4) -> Column:
    """Whole-number id in a path segment; NULL where the segment is anything but digits or beyond 31 bits."""
    segment = path_segment(column, position)
    return F.when(segment.rlike(r"\A[0-9]+\z"), segment.try_cast("int"))


def time_key(column: Column | str, pattern: str = MINUTE_KEY) -> Column:
    """Sortable text key of a time bucket."""
    return F.date_format(_col(column), pattern)


def element(column: Column | str, index: int) -> Column:
    """Array element from 0, or from the end when negative; NULL out of range."""
    return F.get(_col(column), F.lit(index)) if index >= 0 else F.try_element_at(_col(column), F.lit(index))


def explode_words(df: DataFrame, keys: list[str], text: str, name: str = "word",
                  position: str | None = None, parent: str | None = None, keep_empty: bool = False) -> DataFrame:
    """One row per word with the parent keys; with ``keep_empty`` one row without a word for a text that has none.

    On request also the 0-based position, and a ``parent`` number that is unique
    per input row, for telling rows with equal keys apart.
    """
    if parent:
        df, keys = df.withColumn(parent, F.monotonically_increasing_id()), [*keys, parent]
    if position:
        explode = F.posexplode_outer if keep_empty else F.posexplode
        return df.select(*keys, explode(words(text)).alias(position, name))
    return df.select(*keys, (F.explode_outer if keep_empty else F.explode)(words(text)).alias(name))


def word_frequencies(df: DataFrame, text: str, name: str = "count") -> DataFrame:
    """Occurrences of each word; counted before the shuffle, so frequent words stay cheap."""
    return explode_words(df, [], text).groupBy("word").agg(F.count(F.lit(1)).alias(name))


def word_runs(df: DataFrame, keys: list[str], word: str, position: str) -> DataFrame:
    """Neighbouring rows of a task as one: keys, ``_run`` as struct<first position, number of words n, text>.

    A run has equal keys and rising positions, and its words are joined by blanks; a word with a blank,
    or without a position, is a run of its own. ``_run`` is NULL for a row without a word.
    """
    def same_as_before(column: pa.Array) -> np.ndarray:
        # values that Arrow can't compare count as different
        if pa.types.is_nested(column.type):
            return np.zeros(len(column) - 1, bool)
        equal = pc.fill_null(pc.equal(column[1:], column[:-1]), False)
        return pc.or_(equal, pc.and_(pc.is_null(column[1:]), pc.is_null(column[:-1]))).to_numpy(zero_copy_only=False)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.table([*batch.columns[:-2], batch.column(len(keys)).cast(pa.int64()), batch.column(len(keys) + 1)],
                             [*[f"k{i}" for i in range(len(keys))], "pos", "word"])
            n, pos, text = len(table), table["pos"].combine_chunks(), table["word"].combine_chunks()
            if not n:
                continue
            alone = pc.fill_null(pc.or_(pc.is_null(pos), pc.match_substring(text, " ")), True).to_numpy(zero_copy_only=False)
            joined = pc.fill_null(pc.equal(pos[1:], pc.add(pos[:-1], 1)), False).to_numpy(zero_copy_only=False)
            for i in range(len(keys)):
                joined = joined & same_as_before(table[f"k{i}"].combine_chunks())
            joined = joined & ~alone[1:] & ~alone[:-1]
            heads = np.flatnonzero(np.append(True, ~joined))
            ends = np.append(heads[1:], n)
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(heads, n), pa.int32()), text), " ")
            at = pa.array(heads)
            run = pa.StructArray.from_arrays([pos.take(at).cast(pa.int32()), pa.array(ends - heads, pa.int32()), texts], ["first", "n", "text"],
                                             mask=pc.is_null(text.take(at)))
            yield pa.RecordBatch.from_arrays([*[c.take(at) for c in batch.columns[:-2]], run], [*keys, "_run"])
    rows = df.select(*keys, F.col(position), F.col(word))
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("_run", T.StructType.fromDDL("first int, n int, text string"))])
    return rows.mapInArrow(made, schema)


def renest_words(df: DataFrame, keys: list[str], word: str, position: str, name: str) -> DataFrame:
    """Inverse of the positional explode: words of a parent in their old order as one text.

    Parents without words are there, with an empty text, when they were kept. With the parent number among the keys, a group is never more than what one
    row held before. Words that a task holds side by side are sent as one text, not one by one.
    """
    runs = word_runs(df, keys, word, position).groupBy(*keys).agg(F.collect_list("_run").alias("_runs"))
    pairs = F.flatten(F.transform("_runs", lambda r: F.when(r["n"] == 1, F.array(F.struct(r["first"].alias("at"), r["text"].alias("word"))))
                                  .otherwise(F.transform(F.split(r["text"], " "), lambda w, i: F.struct((r["first"] + i).alias("at"), w.alias("word"))))))
    return runs.select(*keys, F.array_join(F.transform(F.sort_array(pairs), lambda p: p["word"]), " ").alias(name))
