"""Benchmark decontamination with SimHash windows of the size of each item.

For every number of words that a benchmark item has, each window of that many
words of each text gets a SimHash of its words, from running bit counts. The
fingerprints of the items are indexed by their two halves; a window within the
radius of an item has a half within half the radius of the item's, so the index
gives all such pairs and few others. Windows within the radius are then compared
with the item exactly, by the weighted shingles of both.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.staging import remove, stage
from millrace.llm.words import row_groups

BITS, HALF = 32, 16

#: Share of the copies with one other word, among those that the exact rule accepts, that lie within the radius.
RECALL = 0.92

#: Words of texts handled together in a worker; a longer text is a group of its own.
GROUP_WORDS = 60_000

#: Keeps ASCII letters and digits and all bytes above ASCII; the rest separates words.
_SEPARATE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and characters beyond ASCII."""
    return text.lower().encode().translate(_SEPARATE).split() if text else []


def shingles(words: list[bytes], size: int) -> Counter:
    """Runs of ``size`` words with their counts; fewer words are one shingle."""
    return Counter(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else Counter()


def weighted_jaccard(a: Counter, b: Counter) -> float:
    shared = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return shared / (sum(a.values()) + sum(b.values()) - shared) if a or b else 0.0


class Hashes(dict):
    """Word hashes, kept up to a bound per worker process."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh32_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > 1_000_000:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint32, len(words))


def shingle_codes(hashes: np.ndarray, length: int) -> np.ndarray:
    """32-bit code of the words [i, i + length) for every i."""
    code = np.zeros(max(0, len(hashes) - length + 1), np.uint64)
    for word in range(length):
        code = (code ^ hashes[word:word + len(code)]) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return (code >> np.uint64(32)).astype(np.uint32)


def running_counts(hashes: np.ndarray, longest: int) -> np.ndarray:
    """Row i counts each bit over the first i words, modulo a number above ``longest``, so differences stay exact."""
    kind = np.uint8 if longest < 256 else np.uint16 if longest < 65536 else np.uint32
    counts = np.zeros((len(hashes) + 1, BITS), kind)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, BITS // 8), axis=1, bitorder="little")
    np.cumsum(bits, axis=0, dtype=kind, out=counts[1:])
    return counts


#: Work space of this process by kind: fresh memory of this size for every call costs more than the work in it.
_SPACE: dict[str, np.ndarray] = {}


def _space(kind: np.dtype, size: int) -> np.ndarray:
    found = _SPACE.get(kind.char)
    if found is None or len(found) < size:
        found = _SPACE[kind.char] = np.empty(max(size, GROUP_WORDS * BITS), kind)
    return found[:size]


def window_marks(counts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the words [i, i + size) for every i."""
    flat = counts.ravel()
    span = max(0, len(flat) - size * BITS)
    inside = np.subtract(flat[size * BITS:], flat[:span], out=_space(flat.dtype, span))
    most = np.greater(inside, size // 2, out=_space(np.dtype(bool), span))
    return np.packbits(most, bitorder="little").view(np.uint32)


def allowed_radius(n: int, size: int, similarity: float, recall: float = RECALL) -> int:
    """Bits that a copy of ``n`` words may differ in: enough for ``recall`` of the copies with one other word.

    A word at the edge is in one shingle, so another one there leaves (s - 1) / (s + 1) of
    s shingles alike; where that is too little only unchanged copies count. A bit of the
    mark turns where n - 1 shared words are at a tie and the other word decides; bits
    turn independently.
    """
    runs = max(1, n - size + 1)
    if (runs - 1) / (runs + 1) < similarity:
        return 0
    shared = [math.comb(n - 1, k) / 2 ** (n - 1) for k in range(n)] if n < 1000 else None
    turn = 0.5 * shared[n // 2] if shared else 0.5 / math.sqrt(math.pi * n / 2)
    total = 0.0
    for radius in range(BITS + 1):
        total += math.comb(BITS, radius) * turn ** radius * (1 - turn) ** (BITS - radius)
        if total >= recall:
            return radius
    return BITS


class Blocks:
    """Marks of items by the values of their two halves, for windows that differ in ``radius`` bits at most.

    Either the low half then differs in radius / 2 bits at most, or the high half in fewer
    than what is left; all values that near to an item's half lead to the item.
    """

    def __init__(self, marks: np.ndarray, radius: int):
        self.marks, self.radius, self.low = marks, radius, radius // 2
        self.halves = []
        for half, most in enumerate((self.low, radius - self.low - 1)):
            near = np.array([sum(1 << b for b in bits) for k in range(most + 1) for bits in combinations(range(HALF), k)], np.uint16)
            values = (marks.view(np.uint16).reshape(-1, BITS // HALF)[:, half, None] ^ near).ravel()
            order = np.argsort(values, kind="stable")
            starts = np.concatenate([[0], np.cumsum(np.bincount(values, minlength=1 << HALF))])
            self.halves.append((starts, (order // max(1, len(near))).astype(np.int32), np.diff(starts) > 0))

    def within(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, differing bits) of all pairs within the radius."""
        sides, found = windows.view(np.uint16).reshape(-1, BITS // HALF), []
        for half, (starts, items, known) in enumerate(self.halves):
            if not len(items):
                continue
            side = sides[:, half]
            at = np.flatnonzero(known.take(side))
            # in slices, so that memory stays bounded with many items to a value
            for low in range(0, len(at), 4096):
                here = at[low:low + 4096]
                value = side[here].astype(np.int64)
                first = starts[value]
                many = starts[value + 1] - first
                window = np.repeat(here, many)
                item = items[np.arange(len(window)) + np.repeat(first - (np.cumsum(many) - many), many)]
                apart = windows[window] ^ self.marks[item]
                bits = np.bitwise_count(apart)
                close = bits <= self.radius
                if half:
                    # pairs near in the low half have been found there
                    close &= np.bitwise_count(apart & np.uint32((1 << HALF) - 1)) > self.low
                found.append((window[close], item[close], bits[close]))
        if not found:
            return (np.empty(0, np.int64),) * 3
        return tuple(np.concatenate(c) for c in zip(*found))


class Items:
    """Benchmark items by number of words, with the blocks of their fingerprints."""

    def __init__(self, keys: list, texts: list[str | None], radius: int | None, size: int, similarity: float):
        self.size = size
        hashes = Hashes()
        self.keys, self.words, self.shingles = [], [], []
        by_size = defaultdict(list)
        for key, text in zip(keys, texts):
            if words := words_of(text):
                by_size[len(words)].append((len(self.keys), window_marks(running_counts(hashes.of(words), len(words)), len(words))[0]))
                self.keys.append(key)
                self.words.append(words)
                self.shingles.append(shingles(words, size))
        # (item, shingle) pairs and shingles as sorted numbers, to count a window's shingles that an item has
        pairs = [np.unique(shingle_codes(hashes.of(words), min(size, len(words)))).astype(np.int64) | i << 32
                 for i, words in enumerate(self.words)]
        self.pairs = np.concatenate(pairs) if pairs else np.empty(0, np.int64)
        self.known = np.unique(self.pairs & 0xFFFFFFFF).astype(np.uint32)
        self.longest = max(by_size, default=0)
        self.sizes = {n: (np.array([i for i, _ in found]), Blocks(
            np.array([m for _, m in found], np.uint32), allowed_radius(n, size, similarity) if radius is None else radius))
            for n, found in by_size.items()}

    def candidates(self, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, item, differing bits) of every window of ``n`` words within the radius of an item of ``n`` words."""
        ids, blocks = self.sizes[n]
        window, item, apart = blocks.within(window_marks(counts, n))
        return window, ids[item], apart

    def shared(self, codes: np.ndarray, window: np.ndarray, item: np.ndarray, runs: int) -> np.ndarray:
        """How many of the ``runs`` shingles of each window its item has, or a few more where codes are equal by chance."""
        found = np.empty(len(window), np.int64)
        for low in range(0, len(window), 4096):
            here = slice(low, low + 4096)
            wanted = codes[window[here, None] + np.arange(runs)].astype(np.int64) | item[here, None].astype(np.int64) << 32
            at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
            found[here] = (self.pairs[at] == wanted).sum(axis=1)
        return found


#: The items of the last benchmark block of this worker process, by what made them, and the hashes of words met.
_ITEMS: dict[tuple, tuple[Items, Hashes]] = {}


def leaks(texts: list[str | None], items: Items, hashes: Hashes, similarity: float) -> list[list[tuple]]:
    """Per text the (item, first word, words, similarity, differing bits) of verified windows that do not overlap."""
    found: list[list[tuple]] = [[] for _ in texts]
    if not items.sizes:
        return found
    sizes = [len(t) // 6 + 1 if t else 1 for t in texts]
    for start, stop in row_groups(sizes, GROUP_WORDS):
        words = [words_of(t) for t in texts[start:stop]]
        ends = np.cumsum([len(w) for w in words])
        every = [w for ws in words for w in ws]
        hashed = hashes.of(every)
        counts = running_counts(hashed, items.longest)
        coded = {}
        verified = defaultdict(list)
        for n in items.sizes:
            if n > len(every):
                continue
            place, item, apart = items.candidates(counts, n)
            if not len(place):
                continue
            row = np.searchsorted(ends, place, side="right")
            left = np.flatnonzero(place + n <= ends[row])
            length = min(items.size, n)
            if length not in coded:
                codes = shingle_codes(hashed, length)
                coded[length] = codes, np.concatenate([[0], np.cumsum(np.isin(codes, items.known))])
            codes, known = coded[length]
            # of equally many shingles, so many have to be shared for the similarity, each at a place of its own
            runs = n - length + 1
            least = 2 * similarity / (1 + similarity) * runs - 1e-9
            left = left[known[place[left] + runs] - known[place[left]] >= least]
            left = left[items.shared(codes, place[left], item[left], runs) >= least]
            for first, i, r, bits in zip(*(c[left].tolist() for c in (place, item, row, apart))):
                window = every[first:first + n]
                alike = 1.0 if window == items.words[i] else weighted_jaccard(shingles(window, items.size), items.shingles[i])
                if alike >= similarity:
                    verified[r, i].append((-alike, first - int(ends[r] - len(words[r])), bits, n))
        for (row, item), windows in verified.items():
            taken: list[tuple[int, int]] = []
            for alike, first, apart, n in sorted(windows):
                if all(first + n <= a or first >= b for a, b in taken):
                    taken.append((first, first + n))
                    found[start + row].append((item, first, n, -alike, apart))
    return [sorted(f) for f in found]


def leak_column(text: Column, item_type: pa.DataType, key_type: str, radius: int | None, size: int, similarity: float,
                shared) -> Column:
    """array<struct<item, first_word, n_words, similarity, distance>> of each whole text."""
    name = (uuid.uuid4().hex, radius, size, similarity)

    @F.arrow_udf(f"array<struct<item:{key_type},first_word:bigint,n_words:bigint,similarity:double,distance:int>>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if name not in _ITEMS:
            _ITEMS.clear()
            _ITEMS[name] = Items(*shared.value, radius, size, similarity), Hashes()
        items, hashes = _ITEMS[name]
        kind = pa.list_(pa.struct([("item", item_type), ("first_word", pa.int64()), ("n_words", pa.int64()),
                                   ("similarity", pa.float64()), ("distance", pa.int32())]))
        names = ("first_word", "n_words", "similarity", "distance")
        for batch in batches:
            rows = leaks(batch.to_pylist(), items, hashes, similarity)
            yield pa.array([[{"item": items.keys[i], **dict(zip(names, rest))} for i, *rest in row] for row in rows], kind)
    return found(text)


def with_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", into: str = "leaks",
               item: str = "item_id", item_text: str = "text", radius: int | None = None, size: int = 5, similarity: float = 0.8,
               block_words: int = 2_000_000) -> DataFrame:
    """``docs`` with an array column ``into`` of the benchmark items found in each whole text.

    One pass over ``docs`` without a shuffle per block of the benchmark. A block has
    about ``block_words`` words and is the only thing sent to the executors; a larger
    benchmark takes more passes, each staged before the next block is sent. The radius is
    that of ``allowed_radius`` for the size of an item, or ``radius`` for all. Null and empty texts hold nothing, items without
    words are left out, texts shorter than an item cannot hold it, repeated rows are
    judged alike, equal items are all reported, an empty benchmark or table is fine,
    and an existing column named ``into`` is replaced. Words without separators
    between them (some scripts) are one word.
    """
    spark = docs.sparkSession
    wanted = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text")).where("text is not null").distinct()
    total = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / (6 * block_words)))
    kind = benchmark.schema[item].dataType
    item_type = to_arrow_type(kind)
    before = None
    for block in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).toArrow()
        keys = part.column("item").combine_chunks().cast(item_type)
        shared = spark.sparkContext.broadcast((keys.to_pylist(), part.column("text").to_pylist()))
        found = leak_column(F.col(text), item_type, kind.simpleString(), radius, size, similarity, shared)
        if blocks == 1:
            return docs.withColumn(into, found)
        docs, path = stage(docs.withColumn(into, F.concat(into, found) if before else found), "leaks")
        shared.destroy()
        if before:
            remove(spark, before)
        before = path
    return docs


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """A row per text and benchmark item found in it: key, ``item_id``, ``first_word``, ``n_words``, ``similarity``, ``distance``.

    A field that is called like the key has an underscore after its name.
    """
    found = with_leaks(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), benchmark, **options)
    fields = {"item": "item_id", **{c: c for c in ("first_word", "n_words", "similarity", "distance")}}
    return found.select(F.col("key").alias(key), F.explode("leaks").alias("leak")).select(
        key, *[F.col(f"leak.{f}").alias(c + "_" if c == key else c) for f, c in fields.items()])


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with the columns of ``docs``."""
    name = "leaks"
    while name in docs.columns:
        name += "_"
    return (with_leaks(docs, benchmark, text, name, **options).where(F.size(name) == 0)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def _query(spark, folder):
    from millrace.llm.catalog import table
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {"op1_decontaminate": (_query, None)}
