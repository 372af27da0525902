"""Words, keys and row groups shared by the text operators."""

from __future__ import annotations

import itertools
import os
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The six ASCII characters that separate words; ``bytes.split()`` uses the same ones.
SPACES = " \t\n\x0b\x0c\r"


def raw(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [b"" if x is None else x for x in texts.cast(pa.binary()).to_pylist()]


def numbered(words: list[bytes], known: dict | None = None) -> np.ndarray:
    """Each word's number, given out in order of first appearance."""
    known = defaultdict(itertools.count().__next__) if known is None else known
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def load_tokenizer(path: str):
    """A tokenizer that stays in its task's core: threads of its own would take those of other tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def encode_each(tokenizer, texts: list[str], size: int = 4000) -> Iterator[list[int]]:
    """Ids of each text without added tokens; encodings are large, so only ``size`` are held at a time."""
    for start in range(0, len(texts), size):
        for encoding in tokenizer.encode_batch_fast(texts[start:start + size], add_special_tokens=False):
            yield encoding.ids


def row_groups(sizes: list[int], most: int):
    """Slices of consecutive rows with ``most`` units together, or one row above that."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def content_key(key: str, text: str) -> Column:
    """64 bits of a row's content. Together with the key it tells rows apart that share a key."""
    return F.xxhash64(F.col(key).cast("string"), F.col(text))


def local_table(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """A frame of rows given as parameters. From Arrow, so that Spark knows its true size when it plans joins."""
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema))
