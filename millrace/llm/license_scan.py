"""License scans by diagonal voting.

Every run of k words of every text is hashed and joined with the same runs of the
template texts. A hit at text position i and template position j votes for the
diagonal i - j: an unchanged copy of a template gives all its votes to one
diagonal, one with words put in or left out to neighbouring diagonals, which are
merged. A span counts when the share of the template's runs found in it, each
compared as text, is large enough and it is verified: all words that decide between
licenses, such as version numbers, stand in it as in the template, no word that
makes it another license does, and of spans of one family that overlap the best stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.llm.words import content_key, local_table, raw, row_groups

#: Keeps digits, lower-case ASCII letters and all bytes beyond ASCII; the rest separates words.
SEPARATE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

#: Words per run. Two is the most that the shortest phrase allows.
K = 2

#: Words of texts handled together in a worker.
GROUP_BYTES = 2_000_000


#: Words that tell one license of a family from another: a template's own have to stand in a span (fixed values).
VERSIONS = ("1", "2", "3", "4", "5")

#: Words of that kind that must not stand in a span of a template without them either (fixed values).
TERMS = ("nc", "nd", "noderivatives", "noderivs", "noncommercial", "sa", "sharealike", "lesser", "affero")

DECIDING = VERSIONS + TERMS


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False


#: Phrases that count wherever their words stand one after the other.
PHRASES = (Template("cc-by", "cc by", True), Template("gpl", "general public license", True),
           Template("reserved", "all rights reserved", True))

#: Statements that count when most of them is found, also with changed words.
STATEMENTS = (
    Template("apache-2.0", "licensed under the apache license version 2.0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"
                    " provided that the following conditions are met"),
    Template("cc-by-4.0", "this work is licensed under a creative commons attribution 4.0 international license"),
    Template("cc-by-nc-4.0", "licensed under cc by-nc 4.0"),
    Template("cc-by-sa-4.0", "licensed under cc by-sa 4.0"),
    Template("gpl-2.0", "this work is licensed under the gnu general public license version 2"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"
                    " and associated documentation files"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license version 2.0"),
)


_DECIDING = {w.encode(): xxhash.xxh64_intdigest(w) for w in DECIDING}


def words_of(blob: bytes) -> list[bytes]:
    """Words of a text, after A-Z are lower-cased."""
    return blob.lower().translate(SEPARATE).split()


def runs(words: list[bytes], k: int, kept: dict[bytes, int]) -> tuple[np.ndarray, list[bytes]]:
    """Rolling hashes of all runs of ``k`` words, mixed from word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), []
    for w in words:
        if w not in kept:
            kept[w] = xxhash.xxh64_intdigest(w)
    hashes = np.fromiter(map(kept.__getitem__, words), np.uint64, len(words))
    mixed = np.zeros(n, np.uint64)
    for j in range(k):
        mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) ^ (hashes[j:j + n] >> np.uint64(1))
        mixed ^= mixed >> np.uint64(29)
    texts = words[:n]
    for j in range(1, k):
        texts = list(map(b"%b %b".__mod__, zip(texts, words[j:j + n])))
    return mixed, texts


def _scan_words(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    kept: dict[bytes, int] = {}
    for batch in batches:
        blobs = raw(batch.column(2))
        for start, stop in row_groups([len(b) for b in blobs], GROUP_BYTES):
            if len(kept) > 500_000:
                kept = {}
            counts, hashes, texts, places = [], [], [], []
            for blob in blobs[start:stop]:
                words = words_of(blob)
                mixed, found = runs(words, k, kept)
                deciding = [i for i, w in enumerate(words) if w in _DECIDING]
                # the first row of a text stands for the text itself
                hashes += [np.zeros(1, np.uint64), mixed, np.array([_DECIDING[words[i]] for i in deciding], np.uint64)]
                texts.append(b"")
                texts += found
                texts += [words[i] for i in deciding]
                places += [np.array([len(words)]), np.arange(len(found)), np.array(deciding, np.int64)]
                counts.append(1 + len(found) + len(deciding))
            row = pa.array(np.repeat(np.arange(start, stop), counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row),
                 pa.array(np.concatenate(places), pa.int64()), pa.array(np.concatenate(hashes).view(np.int64)),
                 pa.array(texts, pa.binary()).cast(pa.string())],
                ["key", "content", "place", "run_hash", "run"])


def template_runs(templates, k: int) -> tuple[list, list]:
    """Rows (template, position, hash, run) and (template, label, is a phrase, runs, deciding words needed, barred)."""
    places, facts = [(-1, 0, 0, "")], []
    # deciding words have negative numbers in place of a template
    places += [(-2 - i, 0, int(np.uint64(_DECIDING[w.encode()]).view(np.int64)), w) for i, w in enumerate(DECIDING)]
    for t, template in enumerate(templates):
        hashes, texts = runs(words_of(template.text.encode()), k, {})
        if not texts:
            raise ValueError(f"template {template.label} has fewer than {k} words")
        places += [(t, j, int(h), s.decode()) for j, (h, s) in enumerate(zip(hashes.view(np.int64), texts))]
        own = set(words_of(template.text.encode()))
        needed = [-2 - i for i, w in enumerate(DECIDING) if w.encode() in own]
        barred = [-2 - i for i, w in enumerate(DECIDING) if w in TERMS and w.encode() not in own]
        facts.append((t, template.label, template.phrase, len(texts), needed, barred))
    return places, facts


def license_hits(docs: DataFrame, templates, key: str, text: str, k: int) -> DataFrame:
    """Votes (key, content, template, diagonal, positions, last place); template -1 stands for the text itself."""
    spark = docs.sparkSession
    key_type = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), content_key(key, text).alias("content"), F.col(text).alias("text"))
    scanned = source.mapInArrow(lambda batches: _scan_words(batches, k),
                                f"key {key_type}, content bigint, place bigint, run_hash bigint, run string")
    places, _ = template_runs(templates, k)
    wanted = local_table(spark, places, pa.schema([("template", pa.int32()), ("position", pa.int32()), ("run_hash", pa.int64()),
                                                   ("wanted", pa.string())]))
    hits = scanned.join(wanted, "run_hash").where(F.col("run") == F.col("wanted"))
    # positions are bounded by the template's length, however often the text repeats them
    return (hits.groupBy("key", "content", "template", (F.col("place") - F.col("position")).alias("diagonal"))
            .agg(F.collect_set("position").alias("positions"), F.count(F.lit(1)).alias("n")))


def scan_licenses(docs: DataFrame, templates=PHRASES + STATEMENTS, key: str = "doc_id", text: str = "text", k: int = K,
                  similarity: float = 0.8, gap: int = 4) -> DataFrame:
    """Licenses named in every whole text, a row per input row.

    Columns: key, ``n_words``, ``places`` (array of (label, start) of the phrases),
    ``spans`` (array of (label, first, last, similarity) of the statements, text
    positions in words). Neighbouring diagonals up to ``gap`` words apart are one
    span; a statement is found when ``similarity`` of its runs are and the span holds
    the deciding words of the template and no barred ones. Where spans of one family (the
    label up to its first hyphen) overlap, the most similar one stays, then the one with
    the smaller label, then the earlier one.

    Null and empty texts have no words and no finds; rows equal in key and text are
    counted once and given out as often as they occur; other columns are left out; an
    empty table gives no rows. A phrase or line that stands in every text adds one
    row per text and diagonal, spread by key and content.
    """
    _, facts = template_runs(templates, k)
    votes = license_hits(docs, templates, key, text, k)
    # templates are few and short, so their facts come as a list of constants
    def fact(i: int, template: Column) -> Column:
        lit = lambda x: F.array(*map(F.lit, x)).cast("array<int>") if isinstance(x, list) else F.lit(x)
        return F.create_map(*(lit(x) for t, *rest in facts for x in (t, rest[i])))[template]

    votes = votes.withColumns({c: fact(i, F.col("template")) for i, c in enumerate(("label", "phrase", "runs"))})
    line = W.partitionBy("key", "content", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(line) > gap) | F.coalesce("phrase", F.lit(True))
    grouped = votes.withColumn("group", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(line))
    first = F.col("diagonal") + F.array_min("positions")
    last = F.col("diagonal") + F.array_max("positions") + (k - 1)
    spans = (grouped.groupBy("key", "content", "template", "group").agg(
        F.first("label").alias("label"), F.first("phrase").alias("phrase"), F.first("runs").alias("runs"),
        F.size(F.array_distinct(F.flatten(F.collect_list("positions")))).alias("found"),
        F.min(first).alias("first"), F.max(last).alias("last"), F.first("diagonal").alias("diagonal"), F.first("n").alias("n")))
    share = F.col("found") / F.col("runs")
    place = F.when(F.col("phrase") & (F.col("found") == F.col("runs")), F.struct("label", F.col("first").alias("start")))
    span = F.when(~F.col("phrase") & (share >= similarity),
                  F.struct("label", "first", "last", share.alias("similarity"), "template"))
    whole = F.col("template") == -1
    mark = F.when(F.col("template") < -1, F.struct(F.col("template").alias("word"), F.col("first").alias("place")))
    texts = spans.groupBy("key", "content").agg(
        F.max(F.when(whole, F.col("n"))).alias("copies"), F.max(F.when(whole, F.col("diagonal"))).alias("n_words"),
        F.array_sort(F.collect_list(place)).alias("places"), F.collect_list(span).alias("spans"), F.collect_list(mark).alias("marks"))

    def verified(s: Column) -> Column:
        inside = F.transform(F.filter("marks", lambda m: m["place"].between(s["first"], s["last"])), lambda m: m["word"])
        return (F.size(F.array_except(fact(3, s["template"]), inside)) == 0) & ~F.arrays_overlap(fact(4, s["template"]), inside)

    def best(s: Column) -> Column:
        """No other span of the family that overlaps is better; of equal ones the first by label and place is."""
        family = lambda x: F.substring_index(x["label"], "-", 1)
        rank = lambda x: F.struct(-x["similarity"], x["label"], x["first"], x["last"], x["template"])
        return ~F.exists("spans", lambda o: (family(o) == family(s)) & (o["first"] <= s["last"]) & (s["first"] <= o["last"])
                         & (rank(o) < rank(s)))
    texts = texts.withColumn("spans", F.filter("spans", verified)).withColumn("spans", F.filter("spans", best))
    plain = F.array_sort(F.transform("spans", lambda s: s.dropFields("template")))
    return (texts.select(F.col("key").alias(key), "n_words", "places", plain.alias("spans"), F.explode(F.sequence(F.lit(1), "copies")))
            .drop("col"))


def _query(spark, folder):
    from millrace.llm.catalog import table
    found = scan_licenses(table(spark, folder, "documents"))
    names = lambda c: F.array_sort(F.array_distinct(c))
    starts = F.transform("places", lambda p: p["start"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(names(F.col("places.label")), ",").alias("base_labels"),
        F.array_join(names(F.concat("places.label", "spans.label")), ",").alias("labels"),
        F.greatest(F.when(F.size("places") > 0, 1.0).otherwise(0.0),
                   F.coalesce(F.array_max("spans.similarity"), F.lit(0.0))).alias("score"))


QUERIES = {"op8_license_scan": (_query, None)}
