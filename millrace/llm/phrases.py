"""Phrases whose words stand together more often than apart, by top-order marginalisation.

Only the longest windows are counted: the word at each position and the words
that follow it as lead columns, padded at the end of a piece. Every shorter
phrase is a prefix of such a window, so one ROLLUP over the lead columns gives
the counts of all lengths, and no n-grams are made per length. A task counts its
windows in chunks before they reach Spark, which keeps frequent words and phrases
from being sent once per occurrence. Windows hold 64-bit hashes of words under a
seed for which no two words of the corpus share one, so counts are exact.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.llm.staging import stage, staging
from millrace.llm.words import numbered

#: Characters that end a piece (fixed values): full stop, comma, semicolon, colon, marks, line feed to carriage return.
ENDS = b".,;:!?\n\x0b\x0c\r"

#: Lower-cases A to Z and turns every end of a piece into a full stop.
_FOLD = bytes(ord(".") if b in ENDS else b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Words a task counts together, and bytes it cuts into words at once.
CHUNK_WORDS, CHUNK_BYTES = 2_000_000, 1 << 20

_ROWS = 65_536


def _slices(blob: bytes) -> Iterator[bytes]:
    """A text in parts of about ``CHUNK_BYTES`` that end where a piece ends; a longer piece is one part."""
    start = 0
    while len(blob) - start > CHUNK_BYTES:
        stop = blob.find(b".", start + CHUNK_BYTES)
        if stop < 0:
            break
        yield blob[start:stop + 1]
        start = stop + 1
    yield blob[start:]


def _distinct(columns: list[np.ndarray], limits: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows in order, and how often each occurs. ``limits``: numbers of a column lie below its limit."""
    bits = [max(1, (limit - 1).bit_length()) for limit in limits]
    if sum(bits) > 63:
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        new = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        heads = np.flatnonzero(np.concatenate([[True], new])[:len(order)])
        return [c[heads] for c in columns], np.diff(np.append(heads, len(order)))
    # a row fits one number, which sorts much faster
    packed = np.zeros(len(columns[0]), np.int64)
    for column, width in zip(columns, bits):
        packed <<= width
        packed |= column
    packed.sort()
    heads = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]])[:len(packed)])
    rows, found = packed[heads], []
    for width in reversed(bits):
        found.append(rows & ((1 << width) - 1))
        rows = rows >> width
    return found[::-1], np.diff(np.append(heads, len(packed)))


class _Counter:
    """Windows of one chunk. Word 0 is the padding, word 1 the end of a piece."""

    def __init__(self, longest: int):
        self.longest, self.words, self.seen = longest, defaultdict(itertools.count().__next__), 0
        numbered([b"", b"."], self.words)
        self.langs: dict[str, int] = {}
        self.parts: list[tuple[int, np.ndarray]] = []

    def add(self, lang: str, blob: bytes) -> None:
        ids = numbered(blob.replace(b".", b" . ").split(), self.words).astype(np.int32)
        # ends are kept between words, and one follows the last word, so windows never leave a text
        self.parts.append((self.langs.setdefault(lang, len(self.langs)), np.append(ids, 1).astype(np.int32)))
        self.seen += len(ids)

    def hashes(self, seed: int) -> np.ndarray:
        """Signed 64-bit hash of every word by number; the padding is 0."""
        found = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.words), np.uint64, len(self.words)).view(np.int64)
        found[0] = 0
        return found

    def windows(self, seed: int) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate([p for _, p in self.parts] + [np.ones(self.longest, np.int32)])
        lang = np.repeat(np.array([g for g, _ in self.parts], np.int32), [len(p) for _, p in self.parts])
        first = np.flatnonzero(ids[:len(lang)] != 1)
        columns, ended = [lang[first], ids[first]], np.zeros(len(first), bool)
        for lead in range(1, self.longest):
            following = ids[first + lead]
            ended |= following == 1
            columns.append(np.where(ended, 0, following).astype(np.int32))
        columns, uses = _distinct(columns, [len(self.langs), *[len(self.words)] * self.longest])
        known, langs = self.hashes(seed), pa.array(list(self.langs), pa.string())
        for low in range(0, len(uses), _ROWS):
            at = slice(low, low + _ROWS)
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(columns[0][at])), *[pa.array(known[c[at]]) for c in columns[1:]],
                 pa.array(uses[at], pa.int64())],
                ["lang", *[f"w{i}" for i in range(1, self.longest + 1)], "uses"])

    def vocabulary(self, seed: int) -> Iterator[pa.RecordBatch]:
        hashes, words = pa.array(self.hashes(seed)), pa.array(list(self.words), pa.binary()).cast(pa.string())
        for low in range(2, len(words), _ROWS):
            yield pa.RecordBatch.from_arrays([hashes[low:low + _ROWS], words[low:low + _ROWS]], ["hash", "word"])


def _chunks(rows: DataFrame, longest: int, schema: str, give: Callable[[_Counter], Iterator[pa.RecordBatch]]) -> DataFrame:
    """What ``give`` makes of every chunk of a task. ``rows``: (lang, text) without nulls."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(longest)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                for part in _slices(text.translate(_FOLD)):
                    counter.add(lang, part)
                    if counter.seen >= CHUNK_WORDS:
                        yield from give(counter)
                        counter = _Counter(longest)
        if counter.parts:
            yield from give(counter)
    return rows.mapInArrow(made, schema)


def window_counts(rows: DataFrame, longest: int, seed: int) -> DataFrame:
    """``lang``, lead columns ``w1`` to ``w<longest>`` (hashes, 0 as padding) and ``uses`` of every window of a chunk."""
    leads = ", ".join(f"w{i} bigint" for i in range(1, longest + 1))
    return _chunks(rows, longest, f"lang string, {leads}, uses bigint", lambda counter: counter.windows(seed))


def vocabulary(put, rows: DataFrame) -> tuple[DataFrame, int]:
    """Staged (hash, word) of all words, and the first seed under which no two words share a hash."""
    for seed in itertools.count():
        found = _chunks(rows, 1, "hash bigint, word string", lambda counter: counter.vocabulary(seed))
        found = put(found.groupBy("hash").agg(F.min("word").alias("word"), F.max("word").alias("last")), "vocabulary")
        if found.where("word <> last OR hash = 0").isEmpty():
            return found.select("hash", "word"), seed


def phrase_counts(rows: DataFrame, longest: int, least: int, seed: int) -> DataFrame:
    """``lang``, ``words`` (hashes), ``f`` of every phrase that occurs ``least`` times; the empty phrase has all word occurrences.

    Windows are dealt by range, so that a phrase's windows lie together: they are added
    up without a further shuffle, and the ROLLUP has few partial sums of each prefix to send.
    """
    leads = [f"w{i}" for i in range(1, longest + 1)]
    whole = window_counts(rows, longest, seed).repartitionByRange("lang", *leads).groupBy("lang", *leads).agg(
        F.sum("uses").alias("f"))
    shorter = ", ".join(leads[:-1])
    rolled = rows.sparkSession.sql(
        f"SELECT lang, {shorter}, sum(f) AS f, grouping_id() AS rolled FROM {{whole}} GROUP BY lang, ROLLUP ({shorter})", whole=whole)
    # a grouping id has one bit for each column that was summed over
    words = F.slice(F.array(*leads[:-1]), F.lit(1), F.lit(longest - 1) - F.bit_count("rolled"))
    found = rolled.select("lang", words.alias("words"), "f").union(whole.select("lang", F.array(*leads), "f"))
    # a padded window is no phrase of that length: its prefix without padding has the count. As a product with the
    # count this stays above the sums, so that both branches of the union read one shuffle
    unpadded = ~F.array_contains("words", F.lit(0).cast("bigint"))
    return found.where(F.col("f") * unpadded.cast("bigint") >= least)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10,
                 covered_share: float = 0.5, top: int | None = 2000) -> DataFrame:
    """The best phrases of 2 to ``longest`` words of every language.

    Texts are lower-cased (A to Z), split into pieces at ``ENDS`` and into words at
    blanks and tabs. A phrase that occurs ``a`` times, at least ``least``, is a
    candidate. Cut after its first k words, its parts occur ``l`` and ``r`` times; the
    score is floor(1000000 a a / (l r)) of the cut where it is lowest, the smallest k
    among equal ones. A candidate goes if a longer candidate that contains its words in
    a row occurs ``covered_share`` times as often or more. The first ``top`` of a
    language by score, occurrences (both falling) and phrase (bytes, rising) come out
    with ``rank``, ``n`` being all word occurrences of the language; all where ``top``
    is None.

    Null languages are ``und``; null and empty texts and pieces without words add
    nothing; repeated rows count each time; other columns are not read; an empty table
    gives no rows. Counts are exact up to 64 bits, products have 38 digits. A single
    piece is held in memory by its task. Every phrase that reaches ``least`` has parts
    that do, so rarer ones are dropped before the joins; adaptive execution splits
    words that very many phrases begin or end with.
    """
    if longest < 2:
        raise ValueError("phrases have two words at least")
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    with staging(docs.sparkSession) as put:
        known, seed = vocabulary(put, rows)
        counts = put(phrase_counts(rows, longest, least, seed), "phrase-counts")
        totals = counts.where(F.size("words") == 0).select("lang", F.col("f").alias("n"))
        phrases = counts.where(F.size("words") > 0)
        parts = phrases.select("lang", F.col("words").alias("part"), "f")
        candidates = phrases.where(F.size("words") > 1).withColumnRenamed("f", "a")

        m = F.size("words")
        cuts = candidates.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), m - 1)).alias("k"))
        cuts = cuts.select("lang", "words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("first"),
                           F.slice("words", F.col("k") + 1, m - F.col("k")).alias("rest"))
        for side, count in (("first", "l"), ("rest", "r")):
            cuts = put(cuts.join(parts.withColumnsRenamed({"part": side, "f": count}), ["lang", side]), f"cuts-{side}")
        wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
        score = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide["a"] * wide["a"]), wide["l"] * wide["r"])
        worst = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("worst")
        scored = cuts.groupBy("lang", "words", "a").agg(worst)

        inner = F.flatten(F.transform(F.sequence(F.lit(2), m - 1), lambda size: F.transform(
            F.sequence(F.lit(1), m - size + 1), lambda at: F.slice("words", at, size))))
        longer = candidates.where(m > 2).select("lang", F.explode(inner).alias("words"), F.col("a").alias("f"))
        covers = longer.groupBy("lang", "words").agg(F.max("f").alias("most"))
        share = round(100 * covered_share)
        found = scored.join(covers, ["lang", "words"], "left").where(
            F.col("most").isNull() | (100 * F.col("most") < share * F.col("a"))).select(
            "lang", "words", "a", "worst.l", "worst.r", "worst.score")
        by = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
        if top is not None:
            # ties at the end stay until the phrases are known
            found = found.withColumn("rank", F.rank().over(by)).where(F.col("rank") <= top).drop("rank")
        found = put(found, "found")
        spelled = found.select("lang", "words", F.posexplode("words").alias("at", "hash")).join(known, "hash").groupBy(
            "lang", "words").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelled"))
        spelled = spelled.select("lang", "words", F.array_join("spelled.word", " ").alias("phrase"))
        by = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
        ranked = found.join(spelled, ["lang", "words"]).withColumn("rank", F.row_number().over(by).cast("bigint"))
        if top is not None:
            ranked = ranked.where(F.col("rank") <= top)
        out, _ = stage(ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrases")
    return out


def _query(spark, folder):
    from millrace.llm.catalog import table
    return collocations(table(spark, folder, "documents").select("lang", "text"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
starts AS (SELECT lang, words, unnest(generate_series(1, len(words))) AS i FROM worded WHERE len(words) > 0),
grams AS (
  SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase
  FROM starts, (VALUES (1), (2), (3)) AS sizes(m) WHERE i + m - 1 <= len(words)),
counts AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE m > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.m, c.phrase, c.a, k, p.f AS l, q.f AS r,
         CAST((1000000::HUGEINT * c.a * c.a) // (p.f::HUGEINT * q.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM candidates) c
  JOIN counts p ON p.lang = c.lang AND p.phrase = array_to_string(c.ws[1:k], ' ') AND p.m = k
  JOIN counts q ON q.lang = c.lang AND q.phrase = array_to_string(c.ws[k + 1:c.m], ' ') AND q.m = c.m - k),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covers AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, a, array_to_string(ws[1:2], ' ') AS phrase FROM candidates WHERE m = 3
    UNION ALL SELECT lang, a, array_to_string(ws[2:3], ' ') FROM candidates WHERE m = 3) GROUP BY ALL),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN covers v ON v.lang = s.lang AND v.phrase = s.phrase AND s.m = 2
  WHERE v.most IS NULL OR 100 * v.most < 50 * s.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score
FROM kept k JOIN totals t ON t.lang = k.lang
QUALIFY rank <= 2000"""

QUERIES = {"op13_phrases": (_query, ORACLE)}
