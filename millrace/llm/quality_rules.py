"""Quality rules on repetition, from a suffix array over the words of each text.

Neighbours in the suffix array share the longest common prefixes. An interval of
neighbours with a common prefix of n words is a substring of n words that occurs
at every position of the interval, and no longer one occurs at all of them. The
deepest interval that holds a position has the larger of its two neighbouring
prefix lengths, so the union of the spans of all intervals is the union of
[p, p + that length). Texts are handled in groups of rows, each word keyed by its
text, so that no match crosses two texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.words import SPACES, numbered, raw, row_groups

#: Words handled together; a longer text is a group of its own.
GROUP_WORDS = 400_000

SYMBOLS = "#*$%&|<>"

RESULT = ("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
          "covered_words:bigint,longest_repeat:bigint>")


def repeat_lengths(values: np.ndarray) -> np.ndarray:
    """For each position the length of the longest sequence that starts there and also at another position.

    ``values``: integers; an integer that occurs once ends every match, so put one
    after each text. Prefix doubling on positions that are not yet told apart; the
    ranks of each doubling give the common prefixes by binary descent.
    """
    n = len(values)
    order = np.argsort(values, kind="stable")
    ranks, slots, width, levels = None, None, 1, []
    sorted_key = values[order]
    while True:
        if ranks is None:
            new = np.empty(n, bool)
            new[:1] = True
            np.not_equal(sorted_key[1:], sorted_key[:-1], out=new[1:])
            heads = np.flatnonzero(new)
            ranks = np.empty(n, np.int32)
            ranks[order] = np.repeat(heads, np.diff(np.append(heads, n)))
            slots = np.arange(n)
        else:
            here = order[slots]
            key = ranks[here].astype(np.int64) * n + ranks[here + width // 2]
            turn = np.argsort(key, kind="stable")
            here, key = here[turn], key[turn]
            order[slots] = here
            new = np.empty(len(key), bool)
            new[:1] = True
            np.not_equal(key[1:], key[:-1], out=new[1:])
            ranks = ranks.copy()
            heads = np.flatnonzero(new)
            ranks[here] = np.repeat(slots[heads], np.diff(np.append(heads, len(key))))
        levels.append((width, ranks))
        alone = new & np.append(new[1:], True)
        slots = slots[~alone]
        if not len(slots):
            break
        width *= 2
    left, right = order[:-1], order[1:]
    common = np.zeros(max(n - 1, 0), np.int64)
    live = np.flatnonzero(levels[0][1][left] == levels[0][1][right])
    a, b = left[live].copy(), right[live].copy()
    for width, ranks in reversed(levels):
        same = ranks[a] == ranks[b]
        common[live[same]] += width
        a[same] += width
        b[same] += width
    longest = np.zeros(n, np.int64)
    longest[left] = common
    longest[right] = np.maximum(longest[right], common)
    return longest


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a span."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def repetition(texts: list[list[bytes]], window: int, shortest: int) -> list[tuple[int, int, int]]:
    """Per text: words in repeated windows, words covered by repeats of ``shortest`` or more, longest repeat."""
    sizes = [len(t) + 1 for t in texts]
    total = sum(sizes)
    ids = numbered([w for t in texts for w in (*t, None)])
    row = np.repeat(np.arange(len(texts)), sizes)
    ends = np.cumsum(sizes) - 1
    key = row * (ids.max() + 2) + ids + 1
    key[ends] = -1 - np.arange(len(texts))
    longest = repeat_lengths(key)
    bounds = ends - np.array(sizes) + 1
    found = []
    for least, cut in ((window, True), (shortest, False)):
        at = np.flatnonzero(longest >= least)
        inside = covered(at, np.full(len(at), least) if cut else longest[at], total)
        found.append(np.add.reduceat(inside.astype(np.int64), bounds))
    found.append(np.maximum.reduceat(longest, bounds))
    return list(zip(*(x.tolist() for x in found)))


def measures(batch: pa.Array, window: int, shortest: int) -> pa.Array:
    rows = []
    blobs = raw(batch)
    for start, stop in row_groups([len(b) // 5 + 1 for b in blobs], GROUP_WORDS):
        texts = [b.split() for b in blobs[start:stop]]
        for blob, words, repeats in zip(blobs[start:stop], texts, repetition(texts, window, shortest)):
            text = blob.decode()
            lines = [x for x in blob.split(b"\n") if x.strip()]
            rows.append((len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
                         len(lines) - len(set(lines)), *repeats))
    columns = list(zip(*rows)) if rows else [()] * 7
    return pa.StructArray.from_arrays(
        [pa.array(c, pa.int64()) for c in columns],
        ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"])


def quality_measures(docs: DataFrame, text: str = "text", into: str = "quality", window: int = 5, shortest: int = 8,
                     min_words: int = 10, window_share: float = 0.2, covered_share: float = 0.3,
                     longest_allowed: int = 250) -> DataFrame:
    """``docs`` with a struct column ``into`` of measures and verdicts; every other column stays as it is.

    ``base_failed``: under ``min_words`` words, or more than ``window_share`` of the
    words lie in windows of ``window`` words that occur again. ``kept``: not
    ``base_failed``, repeats of ``shortest`` words or more cover at most
    ``covered_share`` of the words, and no repeat is longer than
    ``longest_allowed`` words.

    One pass without a shuffle. Null and empty texts have no words and fail;
    repeated rows are judged alike; an existing column named ``into`` is replaced;
    an empty table stays empty. A text is judged whole, in memory of about 100
    bytes a word.
    """
    @F.arrow_udf(RESULT)
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield measures(batch, window, shortest)

    found = F.col(into)
    failed = ((found["n_words"] < min_words)
              | (100 * found["n_repeat_words"] > round(100 * window_share) * found["n_words"]))
    kept = (~failed & (100 * found["covered_words"] <= round(100 * covered_share) * found["n_words"])
            & (found["longest_repeat"] <= longest_allowed))
    # fields are added to the struct so that only one column name is taken
    return (docs.withColumn(into, measured(F.col(text)))
            .withColumn(into, found.withField("base_failed", failed).withField("kept", kept)))


def quality_filter(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    name = "quality"
    while name in docs.columns:
        name += "_"
    return quality_measures(docs, text, name, **limits).where(F.col(name)["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def _query(spark, folder):
    from millrace.llm.catalog import table
    return quality_measures(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", *(f"quality.{c}" for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            "covered_words", "longest_repeat")))


QUERIES = {"op4_quality_rules": (_query, None)}
