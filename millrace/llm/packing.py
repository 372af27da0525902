"""Best-fit packing of texts into sequences, with conflicts.

Pieces come largest first. Bins are kept by residual room, each with bitmaps of
the sources and duplicate clusters it holds. A piece looks at the smallest
residual that is large enough and goes on to the next ones until it finds a bin
that takes its source and cluster; that is the tightest compatible bin. Rows are
dealt to packing blocks of about equal size by a staged row number, so that no
block depends on a source, cluster or key, and blocks are packed side by side.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.staging import stage
from millrace.llm.words import SPACES, raw

CAPACITY = 2048


class Bins:
    """Open bins of one block by residual room."""

    def __init__(self, capacity: int, slots: int):
        self.capacity, self.slots = capacity, slots
        self.occupied = 0                                   # bit r: some bin has r left
        self.levels: list[dict[tuple[int, int], list[int]]] = [{} for _ in range(capacity + 1)]
        self.totals = [0] * (capacity + 1)
        self.closed: list[dict[tuple, int]] = [{} for _ in range(capacity + 1)]   # bins of a residual that refuse a source or cluster
        self.refused: list[list[tuple]] = []                # per bin
        self.sources: dict = {}
        self.clusters: dict = {}

    def _level(self, residual: int, bin_id: int, maps: tuple[int, int], step: int) -> None:
        level, closed = self.levels[residual], self.closed[residual]
        if step > 0:
            level.setdefault(maps, []).append(bin_id)
        self.totals[residual] += step
        for what in self.refused[bin_id]:
            closed[what] = closed.get(what, 0) + step
        if self.totals[residual]:
            self.occupied |= 1 << residual
        else:
            self.occupied &= ~(1 << residual)
            closed.clear()

    def put(self, size: int, source, cluster) -> tuple[int, int]:
        """(bin, start) for a piece."""
        full = (1 << self.slots) - 1
        shift = None if source is None else self.slots * self.sources.setdefault(source, len(self.sources))
        bit = 0 if cluster is None else 1 << self.clusters.setdefault(cluster, len(self.clusters))
        by_source, by_cluster = ("s", source), ("c", cluster)
        residual, rest = size - 1, self.occupied >> size
        while rest:
            step = (rest & -rest).bit_length()
            residual += step
            rest >>= step
            closed, total = self.closed[residual], self.totals[residual]
            if closed.get(by_source, 0) == total or closed.get(by_cluster, 0) == total:
                continue
            for maps, bins in self.levels[residual].items():
                if maps[1] & bit or shift is not None and maps[0] >> shift & full == full:
                    continue
                bin_id = bins.pop()
                if not bins:
                    del self.levels[residual][maps]
                self._level(residual, bin_id, maps, -1)
                return self._place(bin_id, residual, maps, size, shift, bit, by_source, by_cluster)
        self.refused.append([])
        return self._place(len(self.refused) - 1, self.capacity, (0, 0), size, shift, bit, by_source, by_cluster)

    def _place(self, bin_id, residual, maps, size, shift, bit, by_source, by_cluster) -> tuple[int, int]:
        held, doubles = maps
        if shift is not None:
            held |= ((held >> shift << 1 | 1) & ((1 << self.slots) - 1)) << shift
            if held >> shift & (1 << self.slots - 1):
                self.refused[bin_id].append(by_source)
        if bit:
            doubles |= bit
            self.refused[bin_id].append(by_cluster)
        if residual > size:
            self._level(residual - size, bin_id, (held, doubles), 1)
        return bin_id, self.capacity - residual


def pack_block(table: pa.Table, capacity: int, slots: int) -> pa.Table:
    """Pieces of one block with their bins. Ties go by row number, then piece."""
    block = table.column("block")[0].as_py()
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("size", "row", "source", "cluster"))),
                  key=lambda r: (-r[0], r[1]))
    bins = Bins(capacity, slots)
    out = []
    for size, row, source, cluster in rows:
        # whole sequences of a long text fill a bin each; the rest is packed
        whole, rest = divmod(size, capacity)
        for piece in range(whole):
            bins.refused.append([])
            out.append((row, piece, (block << 32) + len(bins.refused) - 1, 0, capacity, size))
    tails = sorted(((s % capacity, r, so, c, s) for s, r, so, c in rows if s % capacity), key=lambda t: (-t[0], t[1]))
    for rest, row, source, cluster, size in tails:
        bin_id, start = bins.put(rest, source, cluster)
        out.append((row, size // capacity, (block << 32) + bin_id, start, rest, size))
    columns = list(zip(*out)) if out else [()] * 6
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["row", "piece", "bin_id", "start", "n_tokens", "size"])


def pack(pieces: DataFrame, capacity: int = CAPACITY, slots: int = 2, block_rows: int = 20_000) -> DataFrame:
    """(row, piece, bin_id, start, n_tokens, size) for a staged (row, size, source, cluster).

    ``row`` is unique, ``size`` at least 1. A bin takes ``capacity`` tokens, up to
    ``slots`` pieces of one source and one of each cluster; null is no source or
    cluster. What exceeds the capacity is split, never dropped.
    """
    if capacity < 1 or slots < 1 or block_rows < 1:
        raise ValueError("capacity, slots and block_rows are 1 or more")
    blocks = max(1, math.ceil(pieces.count() / block_rows))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(
        lambda table: pack_block(table, capacity, slots),
        "row bigint, piece bigint, bin_id bigint, start bigint, n_tokens bigint, size bigint")


def word_count(text: Column) -> Column:
    @F.arrow_udf("bigint")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([len(b.split()) for b in raw(batch)], pa.int64())
    return counted(text)


def copies_of(text: Column) -> Column:
    """Cluster of a text: equal texts but for case and outer blanks; none for texts without words."""
    plain = F.trim(F.lower(text))
    return F.when(F.length(F.translate(plain, SPACES, "")) > 0, F.xxhash64(plain))


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                   capacity: int = CAPACITY, slots: int = 2, block_rows: int = 20_000) -> DataFrame:
    """Where each piece of each row goes: key, ``bin_id``, ``start`` in the bin, ``piece``, ``first_word``, ``n_tokens``.

    A token is a word, and each text has an end token, so null and empty texts take
    one. Repeated rows are packed one by one and, being copies, into different bins.
    Other columns are left out; an empty table gives no rows. The assignment depends
    on the order of the rows in their files, which staging fixes.
    """
    rows, _ = stage(docs.select(F.col(key).alias("key"), (word_count(F.col(text)) + 1).alias("size"),
                                F.col(source).cast("string").alias("source"), copies_of(F.col(text)).alias("cluster"),
                                F.monotonically_increasing_id().alias("row")), "rows")
    placed = pack(rows.select("row", "size", "source", "cluster"), capacity, slots, block_rows)
    return placed.drop("size").join(rows.select("row", "key"), "row").select(
        F.col("key").alias(key), "bin_id", "start", "piece", (F.col("piece") * capacity).alias("first_word"), "n_tokens")


def word_spans(text: Column, first: Column, count: Column) -> Column:
    """The part of each text from word ``first`` on, up to the word that follows the next ``count`` words."""
    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, firsts, counts in batches:
            out = []
            for blob, low, n in zip(raw(texts), firsts.to_pylist(), counts.to_pylist()):
                rest = blob.split(None, low)[low:] if low else [blob]
                if not rest:
                    out.append("")
                    continue
                after = rest[0].split(None, n)
                # without more words, all that is left belongs to this piece
                out.append((rest[0][:len(rest[0]) - len(after[n])] if len(after) > n else rest[0]).decode())
            yield pa.array(out, pa.string())
    return cut(text, first, count)


def packed_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                 capacity: int = CAPACITY, slots: int = 2, block_rows: int = 20_000) -> DataFrame:
    """The packed pieces with their texts: ``bin_id``, ``start``, key, ``piece``, ``n_tokens``, text, a row per piece.

    The pieces of a text put together are the text; the end token has none.
    """
    rows, _ = stage(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), (word_count(F.col(text)) + 1).alias("size"),
                                F.col(source).cast("string").alias("source"), copies_of(F.col(text)).alias("cluster"),
                                F.monotonically_increasing_id().alias("row")), "rows")
    placed = pack(rows.select("row", "size", "source", "cluster"), capacity, slots, block_rows)
    return placed.drop("size").join(rows.select("row", "key", "text"), "row").select(
        "bin_id", "start", F.col("key").alias(key), "piece", "n_tokens",
        word_spans(F.col("text"), F.col("piece") * capacity, F.least("n_tokens", F.lit(capacity))).alias(text))


def _query(spark, folder):
    from millrace.llm.catalog import table
    return pack_documents(table(spark, folder, "documents"))


QUERIES = {"op9_best_fit_packing": (_query, None)}
