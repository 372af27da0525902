"""Language-model scores by Katz backoff over words.

Counts of words and word pairs are Good-Turing discounted up to ``KATZ`` and the
mass that this frees goes to unseen successors in proportion to the word model,
with a weight per context that makes each distribution add up to one exactly:

    P(w|v) = d(c(vw)) c(vw) / c(v)            if the pair was met in training
             a(v) P(w)                        else
    P(w)   = d(c(w)) c(w) / N                 if the word was met, else what is left

Texts are cut into staged blocks of some million tokens, in which each distinct
word and pair counts once. Blocks ask for the totals of their keys: requests go to
buckets of the 64-bit key space, buckets add up and answer in the order of the
request, and the answers come back to the block by a join with the bucketed block
table. Neither a frequent word nor a frequent pair adds more than one entry per
block to a bucket. A pair's first block adds it to the sums of its context.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.staging import stage
from millrace.llm.words import row_groups
from millrace.workspace import new_name, new_path

#: Counts up to this one are discounted.
KATZ = 5

#: UTF-8 bytes of texts in a block, about six to a token.
BLOCK_BYTES = 8_000_000

#: Keys of a bucket on average.
BUCKET_KEYS = 1_500_000

#: They hold white space, so no word is equal to them.
START, END = b"\nstart", b"\nend"


def packed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes, kind, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, decompressed_size=n * np.dtype(kind).itemsize, codec="zstd"), kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as differences, byte by byte, so that the small high bytes lie together."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return packed(steps.view(np.uint8).reshape(-1, 8).T)


def unpack_keys(blob: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(unpacked(blob, np.uint8, 8 * n).reshape(8, n).T).view(np.uint64).ravel(), dtype=np.uint64)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first * np.uint64(0x9E3779B97F4A7C15) ^ second
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ mixed >> np.uint64(32)


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, start, stop) of ascending keys; buckets are equal ranges of the key space."""
    bounds = [(b << 64) // buckets for b in range(1, buckets)]
    cuts = [0, *np.searchsorted(keys, np.array(bounds, np.uint64)).tolist(), len(keys)]
    for bucket, (start, stop) in enumerate(zip(cuts, cuts[1:])):
        if stop > start:
            yield bucket, start, stop


# blocks

BLOCK = "block bigint, keys array<{key}>, held array<boolean>, sizes binary, tokens binary, vocabulary binary, n bigint, v bigint"


def make_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text, held) into blocks: sizes, token numbers and sorted word hashes."""
    number = TaskContext.get().partitionId() << 32
    digest = xxhash.xxh64_intdigest
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        lengths = [x or 0 for x in pa.compute.binary_length(texts).to_pylist()]
        for start, stop in row_groups(lengths, BLOCK_BYTES):
            known: dict[bytes, int] = {START: 0, END: 1}
            streams = []
            for blob in texts.slice(start, stop - start):
                words = (blob.as_py() or b"").lower().split()
                for w in words:
                    if w not in known:
                        known[w] = len(known)
                words.append(END)
                streams.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
            hashes = np.fromiter(map(digest, known), np.uint64, len(known))
            vocabulary, place = np.unique(hashes, return_inverse=True)
            tokens = place.astype(np.int32)[np.concatenate(streams)]
            sizes = np.array([len(s) for s in streams], np.int64)
            held = batch.column(2).slice(start, stop - start)
            columns = [[number], [batch.column(0).slice(start, stop - start)], [held], [packed(sizes)],
                       [packed(tokens.view(np.uint8).reshape(-1, 4).T)], [pack_keys(vocabulary)], [len(tokens)], [len(vocabulary)]]
            kinds = [pa.int64(), pa.list_(batch.column(0).type), pa.list_(pa.bool_()), *[pa.binary()] * 3, pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays([0, stop - start], c[0]) if pa.types.is_list(k) else pa.array(c, k)
                 for c, k in zip(columns, kinds)],
                ["block", "keys", "held", "sizes", "tokens", "vocabulary", "n", "v"])
            number += 1


class Block:
    """Tokens of a block with their contexts, and its distinct pairs in the order of their keys."""

    def __init__(self, row: dict):
        n, v = row["n"], row["v"]
        self.sizes = unpacked(row["sizes"], np.int64, len(row["held"]))
        self.tokens = np.ascontiguousarray(unpacked(row["tokens"], np.uint8, 4 * n).reshape(4, n).T).view(np.int32).ravel()
        self.words = unpack_keys(row["vocabulary"], v)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        contexts = np.empty_like(self.tokens)
        contexts[1:] = self.tokens[:-1]
        contexts[self.firsts] = np.searchsorted(self.words, np.uint64(xxhash.xxh64_intdigest(START)))
        self.trained = np.repeat(~np.array(row["held"], bool), self.sizes)
        codes, self.pair_of = np.unique(contexts.astype(np.int64) * v + self.tokens, return_inverse=True)
        keys = pair_keys(self.words[codes // v], self.words[codes % v])
        order = np.argsort(keys, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        self.pair_of = rank[self.pair_of]
        self.pairs, self.context, self.word = keys[order], codes[order] // v, codes[order] % v


def answers(found: list[dict], kinds: dict) -> dict:
    """Answers of all buckets, put together in the order of the keys."""
    found = sorted(found, key=lambda a: a["bucket"])
    return {name: np.concatenate([unpacked(a[name], kind, a["n"]) for a in found]) if found else np.empty(0, kind)
            for name, kind in kinds.items()}


# totals of words and pairs

REQUEST = "kind int, bucket bigint, block bigint, n bigint, keys binary, counts binary"
TOTALS = {"total": np.uint32, "owner": np.uint8}


def ask_totals(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row)
            for kind, keys, of in ((1, block.words, block.tokens), (2, block.pairs, block.pair_of)):
                counts = np.bincount(of[block.trained], minlength=len(keys)).astype(np.uint32)
                out = [(kind, b, row["block"], stop - start, pack_keys(keys[start:stop]), packed(counts[start:stop]))
                       for b, start, stop in by_bucket(keys, buckets)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), *[pa.int64()] * 3, pa.binary(), pa.binary()))],
                    ["kind", "bucket", "block", "n", "keys", "counts"])


ANSWER = "kind int, bucket bigint, block bigint, n bigint, total binary, owner binary, histogram array<bigint>"


def add_totals(table: pa.Table) -> pa.Table:
    """Answers to each request of one bucket, and a row (block -1) with the histogram of the totals."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    keys = np.concatenate([unpack_keys(r["keys"], r["n"]) for r in rows])
    counts = np.concatenate([unpacked(r["counts"], np.uint32, r["n"]) for r in rows])
    order = np.argsort(keys, kind="stable")
    ascending, mine = keys[order], counts[order].astype(np.int64)
    heads = np.flatnonzero(np.append(True, ascending[1:] != ascending[:-1]))
    group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(keys))))
    sums = np.add.reduceat(mine, heads)
    # the first block that has the key in training texts adds it up for its context
    having = np.flatnonzero(mine)
    _, first = np.unique(group[having], return_index=True)
    total, owner = np.empty(len(keys), np.uint32), np.zeros(len(keys), np.uint8)
    total[order] = np.minimum(sums, 0xFFFFFFFF)[group]
    owner[order[having[first]]] = 1
    histogram = [int(x) for x in np.bincount(np.minimum(sums, KATZ + 2), minlength=KATZ + 3)] + [int(sums.sum())]
    out, at = [(rows[0]["kind"], rows[0]["bucket"], -1, 0, b"", b"", histogram)], 0
    for r in rows:
        part = slice(at, at + r["n"])
        out.append((r["kind"], r["bucket"], r["block"], r["n"], packed(total[part]), packed(owner[part]), None))
        at += r["n"]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), *[pa.int64()] * 3, pa.binary(), pa.binary(),
                                                              pa.list_(pa.int64())))],
                    ["kind", "bucket", "block", "n", "total", "owner", "histogram"])


def discounts(number_of: list[int]) -> np.ndarray:
    """Factor by count, 0 to KATZ + 1, from the numbers of keys met once, twice, ... (``number_of[r]``).

    Good-Turing with Katz's cut-off. Where the numbers do not allow it (a gap, or a
    factor outside (0, 1]), one absolute discount takes its place.
    """
    n = number_of
    factor = np.ones(KATZ + 2)
    if all(n[r] for r in range(1, KATZ + 2)):
        cut = (KATZ + 1) * n[KATZ + 1] / n[1]
        if cut < 1:
            for r in range(1, KATZ + 1):
                factor[r] = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut)
            if (factor[1:KATZ + 1] > 0).all() and (factor <= 1).all() and factor[1] < 1:
                return factor
    less = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    factor[1:] = [1 - less / r for r in range(1, KATZ + 1)] + [1]
    return factor


class Model:
    """The numbers of the whole corpus that every block needs: a few dozen."""

    def __init__(self, histograms: dict[int, list[int]]):
        words = histograms.get(1, [0] * (KATZ + 4))
        self.n, self.v = words[-1], sum(words[1:-1])
        self.word_factor = discounts(words)
        self.pair_factor = discounts(histograms.get(2, words))
        kept = sum(self.word_factor[r] * r * words[r] for r in range(1, KATZ + 1))
        large = self.n - sum(r * words[r] for r in range(1, KATZ + 1))
        # without a discounted count one is added to the whole, so that unmet words keep a share
        self.whole = self.n if kept + large < self.n else self.n + 1
        self.unmet = (self.whole - kept - large) / self.whole

    def word_probability(self, counts: np.ndarray) -> np.ndarray:
        c = counts.astype(np.float64)
        return np.where(counts > 0, self.word_factor[np.minimum(counts, KATZ + 1)] * c / self.whole, self.unmet)


# sums of contexts

CONTEXT_REQUEST = "bucket bigint, block bigint, n bigint, keys binary, count binary, freed binary, lower binary"
CONTEXT_ANSWER = "bucket bigint, block bigint, n bigint, whole binary, weight binary"
WEIGHTS = {"whole": np.int64, "weight": np.float64}


def ask_contexts(batches: Iterator[pa.RecordBatch], buckets: int, model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row)
            word = answers([a for a in row["totals"] if a["kind"] == 1], TOTALS)["total"]
            pair = answers([a for a in row["totals"] if a["kind"] == 2], TOTALS)
            own = np.flatnonzero(pair["owner"])
            counts, at = pair["total"][own], block.context[own]
            n = len(block.words)
            sums = [np.bincount(at, counts, n).astype(np.int64),
                    np.bincount(at, (1 - model.pair_factor[np.minimum(counts, KATZ + 1)]) * counts, n),
                    np.bincount(at, model.word_probability(word)[block.word[own]], n)]
            used = np.zeros(n, bool)
            used[block.context] = True
            keys, sums = block.words[used], [s[used] for s in sums]
            out = [(b, row["block"], stop - start, pack_keys(keys[start:stop]), *(packed(s[start:stop]) for s in sums))
                   for b, start, stop in by_bucket(keys, buckets)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (*[pa.int64()] * 3, *[pa.binary()] * 4))],
                ["bucket", "block", "n", "keys", "count", "freed", "lower"])


def weigh_contexts(table: pa.Table) -> pa.Table:
    """What contexts divide by and their backoff weights; a context not met in training backs off whole."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    keys = np.concatenate([unpack_keys(r["keys"], r["n"]) for r in rows])
    _, group = np.unique(keys, return_inverse=True)
    count, freed, lower = (np.bincount(group, np.concatenate([unpacked(r[c], kind, r["n"]) for r in rows]))
                           for c, kind in (("count", np.int64), ("freed", np.float64), ("lower", np.float64)))
    whole = np.where(freed > 0, count, count + 1)
    weight = np.where(count > 0, np.where(freed > 0, freed, 1) / np.maximum(whole, 1) / np.maximum(1 - lower, 1e-300), 1.0)
    out, at = [], 0
    for r in rows:
        part = group[at:at + r["n"]]
        out.append((r["bucket"], r["block"], r["n"], packed(whole[part].astype(np.int64)), packed(weight[part])))
        at += r["n"]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (*[pa.int64()] * 3, pa.binary(), pa.binary()))],
                    ["bucket", "block", "n", "whole", "weight"])


# scores

def score_blocks(batches: Iterator[pa.RecordBatch], model: Model, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row)
            word = answers([a for a in row["totals"] if a["kind"] == 1], TOTALS)["total"]
            pair = answers([a for a in row["totals"] if a["kind"] == 2], TOTALS)["total"]
            context = answers(row["weights"], WEIGHTS)
            used = np.zeros(len(block.words), bool)
            used[block.context] = True
            place = np.cumsum(used) - 1
            whole, weight = (context[c][place[block.context]] for c in ("whole", "weight"))
            low = model.word_probability(word)[block.word]
            met = pair > 0
            chance = np.where(met, model.pair_factor[np.minimum(pair, KATZ + 1)] * pair / np.maximum(whole, 1), weight * low)
            base = np.log10((word + 0.1) / (model.n + 0.1 * (model.v + 1)))
            sums = [np.add.reduceat(x, block.firsts) for x in (
                np.log10(chance)[block.pair_of], base[block.tokens], (word > 0).astype(np.int64)[block.tokens])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["keys"], key_type), pa.array(row["held"], pa.bool_()), pa.array(block.sizes), pa.array(sums[2]),
                 pa.array(np.full(len(block.sizes), model.n, np.int64)), pa.array(sums[1]), pa.array(sums[0])],
                ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def per_block(found: DataFrame, name: str) -> DataFrame:
    columns = [c for c in found.columns if c != "block"]
    return found.groupBy("block").agg(F.collect_list(F.struct(*columns)).alias(name))


def katz_scores(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """log10 probability of every whole text under a pair model of the texts for which ``held_out`` is not true.

    Columns: key, ``held_out``, ``n_tokens`` (words and an end), ``n_known`` (met in
    training), ``train_tokens``, ``base_score`` (words alone, 0.1 added to each
    count), ``score``. A-Z are lower-cased; words stand between ASCII white space.

    Null and empty texts are an end alone; repeated rows are scored and counted one
    by one; rows with a null mark are training texts; other columns are left out; an
    empty table gives no rows; without any training text all words are unmet and have
    probability one together. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    made = rows.mapInArrow(make_blocks, BLOCK.format(key=kind))
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # bucketed by block, so that answers come to the blocks and blocks are never shuffled
    name = new_name("blocks")
    made.write.format("parquet").option("path", new_path(spark, "blocks")).bucketBy(count, "block").saveAsTable(name)
    blocks = spark.table(name)
    tokens = blocks.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, math.ceil(tokens / BUCKET_KEYS))
    asked = blocks.mapInArrow(lambda b: ask_totals(b, buckets), REQUEST)
    totals, _ = stage(asked.groupBy("kind", "bucket").applyInArrow(add_totals, ANSWER), "totals", ["kind"])
    summed = (totals.where("block = -1").select("kind", F.posexplode("histogram").alias("r", "n"))
              .groupBy("kind", "r").agg(F.sum("n").alias("n")).orderBy("kind", "r").collect())
    model = Model({k: [x.n for x in summed if x.kind == k] for k in {x.kind for x in summed}})
    shared = spark.sparkContext.broadcast(model)
    by_block = blocks.join(per_block(totals.where("block >= 0").select("kind", "bucket", "block", "n", "total", "owner"), "totals"), "block")
    contexts = by_block.mapInArrow(lambda b: ask_contexts(b, buckets, shared.value), CONTEXT_REQUEST)
    weights, _ = stage(contexts.groupBy("bucket").applyInArrow(weigh_contexts, CONTEXT_ANSWER), "weights")
    arrow = blocks.select("keys").limit(0).toArrow().schema.field("keys").type.value_type
    scored = by_block.join(per_block(weights, "weights"), "block").mapInArrow(
        lambda b: score_blocks(b, shared.value, arrow),
        f"key {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return scored.withColumnRenamed("key", key)


def _query(spark, folder):
    from millrace.llm.catalog import table
    return katz_scores(table(spark, folder, "documents"), F.crc32(F.col("doc_id").cast("string")) % 10 == 0)


QUERIES = {"op6_katz_backoff": (_query, None)}
