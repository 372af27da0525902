"""Token counts with a whole-token shortcut.

Byte-level BPE cuts a text into pre-tokens and merges each one alone. Strings of
the vocabulary that come out as one token are found beforehand, by encoding the
vocabulary itself; pre-tokens among them count one without merging, and only the
others are merged. A piece (a space and what follows up to the next one) always
gives the same count, so counts are kept per worker process up to a bound.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.words import encode_each, load_tokenizer, raw, row_groups

#: Bytes of texts cut into pieces at a time; a longer text is cut alone.
GROUP_BYTES = 1_000_000

#: Kept counts per worker process; the store starts anew when full, which changes no result.
KEPT = 250_000

#: The pre-token pattern of byte-level BPE for texts of ASCII characters only (fixed values).
ASCII_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t\n\x0b\x0c\rA-Za-z0-9]+"
    r"|[ \t\n\x0b\x0c\r]+(?![^ \t\n\x0b\x0c\r])|[ \t\n\x0b\x0c\r]+")

#: Pieces with these are merged by the library as they are: white space to some readers only.
CONTROL = re.compile(r"[\x1c-\x1f]")

#: A space with white space before it and white space or the end after it lies inside one pre-token; a text with
#: such a space is not cut. At all other spaces a pre-token begins.
LONG_RUN = re.compile(r"\s (?:\s|\Z)")


def whole_tokens(path: str) -> frozenset[str]:
    """The strings that encode alone as exactly one token, proved by encoding every vocabulary entry.

    Bounded by the vocabulary, whatever the size of the corpus.
    """
    from tokenizers import decoders

    tokenizer = load_tokenizer(path)
    decoder = decoders.ByteLevel()
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    strings = [s for t in tokenizer.get_vocab() if (s := decoder.decode([t])) and "�" not in s and t not in special]
    return frozenset(s for s, ids in zip(strings, encode_each(tokenizer, strings)) if len(ids) == 1)


class Counter:
    """Counts the tokens of texts in one worker process."""

    def __init__(self, path: str, proved: frozenset[str]):
        self.tokenizer = load_tokenizer(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        kind = json.loads(self.tokenizer.to_str())
        if kind["normalizer"] or kind["pre_tokenizer"]["type"] != "ByteLevel" or kind["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("the shortcut is proved for byte-level BPE without a normalizer or prefix space")
        self.proved = proved
        self.kept: dict[str, int] = {}

    def merged(self, pieces: list[str]) -> list[int]:
        return [len(ids) for ids in encode_each(self.tokenizer, pieces)]

    def learn(self, pieces: set[str]) -> None:
        """Counts of pieces not met before: proved pre-tokens count one, the rest is merged."""
        proved, kept, rest, whole = self.proved, self.kept, {}, []
        for piece in pieces:
            if piece in proved:
                kept[piece] = 1
            elif piece.isascii() and not CONTROL.search(piece):
                others = ASCII_PIECES.findall(piece)
                hard = [x for x in others if x not in proved]
                kept[piece] = len(others) - len(hard)
                if hard:
                    rest[piece] = hard
            else:
                whole.append(piece)
        hard = list({x for xs in rest.values() for x in xs})
        counts = dict(zip(hard, self.merged(hard)))
        for piece, xs in rest.items():
            kept[piece] += sum(map(counts.__getitem__, xs))
        kept.update(zip(whole, self.merged(whole)))

    def count(self, texts: list[str]) -> list[int]:
        found, cut = [0] * len(texts), []
        for i, text in enumerate(texts):
            if any(s in text for s in self.special) or LONG_RUN.search(text):
                found[i] = self.merged([text])[0]
            elif text:
                first, *others = text.split(" ")
                cut.append((i, ([first] if first else []) + [" " + x for x in others]))
        if len(self.kept) > KEPT:
            self.kept = {}
        new = {piece for _, pieces in cut for piece in pieces if piece not in self.kept}
        self.learn(new)
        get = self.kept.__getitem__
        for i, pieces in cut:
            found[i] = sum(map(get, pieces))
        return found


#: The counter of this worker process by tokenizer; it goes on from task to task.
_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", limit: int = 1024) -> DataFrame:
    """Bytes and tokens of every whole text: key, ``n_bytes``, ``n_tokens``, ``over_limit``.

    One pass without a shuffle; a row per input row. Null and empty texts have
    zero of both; repeated rows stay; other columns are left out, so their names
    cannot clash; an empty table gives no rows. Special strings inside a text
    are handled as the tokenizers library does by default.
    """
    proved = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    @F.arrow_udf("bigint")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _COUNTERS.get(path) or _COUNTERS.setdefault(path, Counter(path, proved.value))
        for batch in batches:
            blobs = raw(batch)
            yield pa.array([n for start, stop in row_groups([len(b) for b in blobs], GROUP_BYTES)
                            for n in counter.count([b.decode() for b in blobs[start:stop]])], pa.int64())

    counted = docs.select(F.col(key), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
                          tokens(F.col(text)).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def _query(spark, folder):
    from public_tokenizers import path

    from millrace.llm.catalog import table
    return count_tokens(table(spark, folder, "documents"), path("byte_bpe_50k.json"))


QUERIES = {"op2_token_counts": (_query, None)}
