"""SimHash near-duplicates by anchor-point covering.

A 64-bit fingerprint is cut into two halves of 32 bits. Fingerprints that differ
in 3 bits or fewer differ in at most one bit of one half. The anchors of a half
are the words of a perfect code, the Hamming code on 31 bits, times the free
bit: each value lies within one bit of an anchor, its home. If two values differ
in one bit, the home of one lies within 2 = 1 + 1 bits of the other. So each
fingerprint goes to its home and to all (at most 17) anchors within 2 bits, and
homes are compared with guests per anchor. No pair within the radius is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.components import components
from millrace.llm.staging import remove, stage, staging
from millrace.llm.words import raw

#: Largest number of differing bits that two halves and anchors within 2 bits guarantee.
RADIUS = 3

_ROWS = 65_536


def fingerprint(blob: bytes, size: int) -> int:
    """Majority of the bits of the hashes of all runs of ``size`` words; zero without words."""
    words = blob.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    span = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(words) - span + 1
    for low in range(0, n, _ROWS):
        high = min(n, low + _ROWS)
        hashes = np.fromiter((digest(joined[a:b - 1], 42) for a, b in zip(starts[low:high], starts[low + span:high + span])),
                             "<u8", high - low)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, size: int = 3) -> Column:
    """Fingerprint of each whole text as a signed 64-bit number."""
    @F.arrow_udf("bigint")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.array([fingerprint(b, size) for b in raw(batch)], np.uint64).view(np.int64))
    return made(text)


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.expr("1L"), position)


def syndrome(half: Column) -> Column:
    """Zero for a code word, else the position (1 to 31) of the bit to flip."""
    found = F.lit(0)
    for b in range(5):
        mask = sum(1 << (i - 1) for i in range(1, 32) if i >> b & 1)
        found = found + (F.bit_count(half.bitwiseAND(F.lit(mask))) % 2) * (1 << b)
    return found.cast("int")


def with_anchors(marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(side, anchor, mark) of the homes and of the guests of distinct 64-bit ``mark``."""
    low = F.col("mark").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.call_function("shiftrightunsigned", F.col("mark"), F.lit(32))
    halves = marks.select("mark", F.posexplode(F.array(low, high)).alias("side", "half"))
    halves = halves.withColumn("flip", syndrome(F.col("half")))
    halves = halves.withColumn("home", F.when(F.col("flip") == 0, F.col("half")).otherwise(
        F.col("half").bitwiseXOR(_bit(F.col("flip") - 1))))
    # pairs of bits (i, j), i < j, whose positions cancel the syndrome lead to the code words at distance two
    second = F.expr("""transform(filter(sequence(1, 31), i -> flip <> 0 and i < (i ^ flip)),
                       i -> half ^ shiftleft(1L, i - 1) ^ shiftleft(1L, (i ^ flip) - 1))""")
    near = F.concat(F.array("home", F.col("home").bitwiseXOR(F.lit(1 << 31))), second)
    return (halves.select("side", F.col("home").alias("anchor"), "mark"),
            halves.select("side", F.explode(near).alias("anchor"), "mark"))


def fingerprint_links(marks: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b), a < b, of distinct marks that differ in 1 to ``radius`` bits, each once.

    The smaller mark is met at its home, on the first side if the first halves differ
    in one bit at most, else on the second.
    """
    if not 1 <= radius <= RADIUS:
        raise ValueError(f"anchors guarantee radius 1 to {RADIUS}")
    homes, guests = with_anchors(marks)
    guests = guests.withColumnRenamed("mark", "b")
    apart = F.col("mark").bitwiseXOR(F.col("b"))
    first = (F.col("side") == 0) == (F.bit_count(apart.bitwiseAND(F.lit(0xFFFFFFFF))) <= 1)
    return homes.join(guests, ["side", "anchor"]).where(
        (F.col("mark") < F.col("b")) & (F.bit_count(apart) <= radius) & first).select(F.col("mark").alias("a"), "b")


def groups_of(marked: DataFrame, radius: int = RADIUS) -> tuple[DataFrame, str]:
    """Staged (mark, root) of every distinct mark: the smallest mark it is linked with through others, or its own."""
    spark = marked.sparkSession
    with staging(spark) as put:
        marks = put(marked.select("mark").distinct(), "marks")
        roots, path = components(fingerprint_links(marks, radius))
        out = stage(marks.join(roots, marks["mark"] == roots["u"], "left").select(
            "mark", F.coalesce("root", "mark").alias("root")), "groups")
        remove(spark, path)
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3,
                    radius: int = RADIUS) -> DataFrame:
    """Key, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row.

    ``component_id`` is the smallest key that is reached over links of ``radius``
    differing bits or fewer, itself included; rows without a key never name a group
    that has one. Equal fingerprints are one node, so copies are never compared.
    Null and empty texts have the fingerprint zero; repeated rows stay; other columns
    are left out; an empty table gives no rows.
    """
    marked, _ = stage(docs.select(F.col(key).alias("key"), fingerprints(F.col(text), size).alias("mark")), "marked")
    groups, _ = groups_of(marked, radius)
    least = marked.groupBy("mark").agg(F.min("key").alias("least"))
    named = least.join(groups, "mark")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # staged, so that the join with the rows is one of two plain exchanges, or a broadcast where it is small
    by_mark, _ = stage(named.select("mark", "root").join(names, "root").select("mark", "component_id"), "named")
    return marked.join(by_mark, "mark").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def _query(spark, folder):
    from millrace.llm.catalog import table
    return near_duplicates(table(spark, folder, "documents"))


QUERIES = {"op3_simhash_dedup": (_query, None)}
