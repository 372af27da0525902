"""Near copies by the exact rule: texts whose sets of word runs have a Jaccard similarity of 0.8 or more.

Candidates come from lists of texts that share a run. ``run_lists`` makes them of all texts, so that no link is
missed. ``marked_texts`` first takes the texts that have a SimHash fingerprint within 3 bits of another's, found by
anchor points (``llm.simhash_dedup``): of runs of three words, and of the distinct words under ``SEEDS``, which a
changed word moves less; ``counted_lists`` makes the lists of these few, with every run counted:

If runs are put in any one order, two sets of similarity t share a run among the
first n - ceil(t n) + 1 runs of each, n being the set's size. So each text gives out
that many of its runs, texts that give out the same run are candidates, and
candidates are compared whole. The order puts runs that many texts have last, which
keeps the lists of a run short; it decides the cost, never the result. Where the first
run that two texts share stands too far back in one of them for 0.8, they are not compared.

In a list, the text whose runs are shared most leads, and is compared with all others:
a group of copies of one text is linked in as many comparisons as it has members.
Twice, the best text outside the leader's group leads. Then every pair of a list that
is still in two groups is compared, so no link between groups is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.components import components
from millrace.llm.simhash_dedup import fingerprint, fingerprint_links
from millrace.llm.staging import remove, stage, staging
from millrace.llm.words import content_key, raw

#: Every so many-th text is counted to find runs that many texts have; a run that this many of them have is put last,
#: and so many such runs at most are known to the tasks.
COUNTED, OFTEN, KNOWN = 16, 3, 1_000_000

#: Odd factors that make a fingerprint each of the hashes of the distinct words.
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)


def shingles(blob: bytes, size: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``size`` words; of the whole text if it has fewer."""
    words = blob.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    span = min(size, len(words))
    n = len(words) - span + 1
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(joined[a:b - 1]) for a, b in zip(starts, starts[span:])), np.uint64, n))


def likeness(a: Column, b: Column, size: int = 5) -> Column:
    """Jaccard similarity of the sets of runs of ``size`` words; texts without words are alike."""
    @F.arrow_udf("double")
    def made(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        runs = lru_cache(64)(lambda blob: shingles(blob, size))
        for one, other in pairs:
            out = []
            for x, y in zip(raw(one), raw(other)):
                sx, sy = runs(x), runs(y)
                both = len(np.intersect1d(sx, sy, assume_unique=True))
                out.append(both / (len(sx) + len(sy) - both) if len(sx) + len(sy) else 1.0)
            yield pa.array(out, pa.float64())
    return made(a, b)


def all_runs(text: Column, size: int) -> Column:
    @F.arrow_udf("array<bigint>")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([shingles(b, size).view(np.int64) for b in raw(batch)], pa.list_(pa.int64()))
    return made(text)


def frequent_runs(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs that many texts seem to have, and in how many counted ones: ``KNOWN`` numbers at most, as sorted hashes."""
    counted = texts.where(F.pmod("node", F.lit(COUNTED)) == 0).dropDuplicates(["node"])
    found = (counted.select(F.explode(all_runs(F.col("text"), size)).alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "hash").limit(KNOWN).toArrow())
    hashes = found.column("hash").to_numpy().view(np.uint64) if found.num_rows else np.empty(0, np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found.column("n").to_numpy()[order] if found.num_rows else np.empty(0, np.int64)


def given_out(text: Column, size: int, similarity: float, frequent) -> Column:
    """struct<size, runs>: number of distinct runs, and the first of them in the common order."""
    @F.arrow_udf("struct<size: int, runs: array<bigint>>")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, times = frequent.value
        for batch in batches:
            sizes, runs = [], []
            for blob in raw(batch):
                own = shingles(blob, size)
                if len(known):
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    own = own[np.argsort(np.where(known[at] == own, times[at], 0), kind="stable")]
                sizes.append(len(own))
                # rounding up a little too far would lose links, a little too few costs a run
                runs.append(own[:len(own) - math.ceil(similarity * len(own) - 1e-9) + 1].view(np.int64))
            yield pa.StructArray.from_arrays([pa.array(sizes, pa.int32()), pa.array(runs, pa.list_(pa.int64()))], ["size", "runs"])
    return made(text)


def _close(similarity: float) -> Column:
    """Sets of similarity t differ in size by a factor of t at most."""
    small, large = F.least("size", "other_size"), F.greatest("size", "other_size")
    return small >= similarity * large - 1e-9


def _within(similarity: float) -> Column:
    """Sets of similarity t have t / (1 + t) of both sizes in common, all of it from the first common run on."""
    left = F.least(F.col("size") - F.col("place"), F.col("other_size") - F.col("other_place"))
    return left >= similarity / (1 + similarity) * (F.col("size") + F.col("other_size")) - 1e-9


def word_marks(blob: bytes) -> list[int]:
    """SimHash fingerprints of the set of words, one for each of ``SEEDS``; zero without words."""
    known = set(blob.lower().split())
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))
    marks = []
    for seed in SEEDS:
        mixed = (hashes ^ hashes >> np.uint64(29)) * np.uint64(seed)
        mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(SEEDS[0])
        mixed ^= mixed >> np.uint64(29)
        bits = np.unpackbits(mixed.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        marks.append(int(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(known), bitorder="little").view("<u8")[0]))
    return marks


def all_marks(text: Column) -> Column:
    @F.arrow_udf("array<bigint>")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([np.array([fingerprint(b, 3), *word_marks(b)], np.uint64).view(np.int64) for b in raw(batch)], pa.list_(pa.int64()))
    return made(text)


def _of_several(given: DataFrame, name: str = "run") -> DataFrame:
    """Lists that more than one text is in."""
    return given.groupBy(name).agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select(name)


def marked_texts(texts: DataFrame, put) -> DataFrame:
    """Each (node, text) once that has a fingerprint which another text has too, or one within 3 bits of it.

    Fingerprints of all kinds share the anchors; links between kinds count as others do.
    """
    marked = put(texts.select("node", F.explode(all_marks(F.col("text"))).alias("mark")).distinct(), "marked")
    links = fingerprint_links(marked.select("mark").distinct())
    # only the marks of the links are kept, since the links of a dense group are many more
    near = put(links.select(F.explode(F.array("a", "b")).alias("mark")).union(_of_several(marked, "mark")).distinct(), "near-marks")
    needed = put(marked.join(near, "mark", "left_semi").select("node").distinct(), "needed")
    return put(texts.join(needed, "node", "left_semi").dropDuplicates(["node"]), "candidates")


def _prefix(similarity: float) -> Column:
    """How many of its runs a text gives out."""
    return F.col("size") - F.ceil(similarity * F.col("size") - 1e-9).cast("int") + 1


def counted_lists(texts: DataFrame, similarity: float, size: int, put) -> DataFrame:
    """(run, node, size, place) as ``run_lists`` gives, the order being in how many of ``texts`` a run is.

    Runs of one text alone come first in it and are left out.
    """
    every = texts.select("node", all_runs(F.col("text"), size).alias("runs"))
    runs = put(every.select("node", F.size("runs").alias("size"), F.explode("runs").alias("run")), "runs")
    times = put(runs.groupBy("run").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "times")
    shared = runs.join(times.hint("merge"), "run").groupBy("node", "size").agg(
        F.sort_array(F.collect_list(F.struct("times", "run"))).alias("shared"))
    alone = F.col("size") - F.size("shared")
    given = shared.select("node", "size", alone.alias("alone"), F.posexplode(
        F.slice("shared", F.lit(1), F.greatest(_prefix(similarity) - alone, F.lit(0)))).alias("at", "one"))
    return put(given.select("one.run", "node", "size", (F.col("alone") + F.col("at")).alias("place")), "lists")


def run_lists(texts: DataFrame, similarity: float, size: int, put) -> DataFrame:
    """(run, node, size, place): for each run that several texts give out those texts, and its place in their order."""
    frequent = texts.sparkSession.sparkContext.broadcast(frequent_runs(texts, size))
    given = texts.select("node", given_out(F.col("text"), size, similarity, frequent).alias("given")).select(
        "node", "given.size", F.posexplode("given.runs").alias("place", "run"))
    # runs of one text alone go before texts meet; merge joins, since what is shared grows with the texts
    found = put(given.join(put(_of_several(given), "shared").hint("merge"), "run").distinct(), "lists")
    frequent.destroy()
    return found


def near_links(texts: DataFrame, similarity: float = 0.8, size: int = 5, by: str = "runs") -> tuple[DataFrame, str]:
    """Staged (u, root) of every linked node, and its path. ``texts``: (node, text); rows of a node have one text."""
    spark = texts.sparkSession
    with staging(spark) as put:
        if by == "marks":
            texts = marked_texts(texts, put)
            lists = counted_lists(texts, similarity, size, put)
        else:
            lists = run_lists(texts, similarity, size, put)
        own = lists.groupBy("node", "size").agg(F.count(F.lit(1)).alias("met"))
        # the text that gives out the smallest share of runs of its own is most like the common source
        alone = F.round((F.ceil((1 - similarity) * F.col("size")) - F.col("met")) / F.col("size"), 3)
        nodes = put(own.select("node", "size", alone.alias("alone")), "nodes")
        needed = nodes.select("node")
        bodies = put(texts.join(needed, "node", "left_semi").dropDuplicates(["node"]), "bodies")
        lead = F.min(F.struct("alone", "node", F.col("size").alias("other_size"))).alias("lead")

        def verified(pairs: DataFrame) -> DataFrame:
            first, second = (bodies.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in ("a", "b"))
            return put(pairs.join(first, "a").join(second, "b").where(
                likeness(F.col("text_a"), F.col("text_b"), size) >= similarity).select("a", "b"), "links")

        def grouped(links: DataFrame) -> DataFrame:
            roots, path = components(links)
            found = put(nodes.join(roots, F.col("node") == F.col("u"), "left").select(
                "node", "alone", F.coalesce("root", "node").alias("group")), "groups")
            remove(spark, path)
            return found

        def led(members: DataFrame, leaders: DataFrame) -> DataFrame:
            other = members.join(leaders.select("run", "lead.node", "lead.other_size", *[c for c in leaders.columns if c == "lead_group"])
                                 .withColumnRenamed("node", "other"), "run")
            apart = F.col("node") != F.col("other")
            if "lead_group" in leaders.columns:
                apart = apart & (F.col("group") != F.col("lead_group"))
            return other.where(apart & _close(similarity)).select(
                F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()

        ranked = lists.join(nodes.select("node", "alone"), "node")
        first = put(ranked.groupBy("run").agg(lead), "leaders")
        tried = put(led(lists, first), "pairs")
        links = verified(tried)
        for _ in range(2):
            groups = grouped(links)
            members = lists.join(groups, "node")
            heads = first.select("run", F.col("lead.node").alias("node")).join(groups.select("node", F.col("group").alias("head_group")), "node")
            # the best text outside the group of the last leader; lists of one group are done
            outside = members.join(heads.select("run", "head_group"), "run").where("group <> head_group")
            first = put(outside.groupBy("run").agg(lead, F.min_by("group", F.struct("alone", "node")).alias("lead_group")), "leaders")
            pairs = put(led(members, first).join(tried, ["a", "b"], "left_anti"), "pairs")
            links, tried = links.union(verified(pairs)), tried.union(pairs)
        groups = grouped(links)
        members = lists.join(groups.select("node", "group"), "node")
        mixed = members.groupBy("run").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("run")
        members = put(members.join(mixed.hint("merge"), "run"), "members")
        others = members.select("run", F.col("node").alias("other"), F.col("size").alias("other_size"), F.col("place").alias("other_place"), F.col("group").alias("other_group"))
        # a pair is met at its first common run, so it may be left out at all later ones
        rest = members.join(others.hint("merge"), "run").where(
            (F.col("node") < F.col("other")) & (F.col("group") != F.col("other_group")) & _close(similarity) & _within(similarity))
        rest = put(rest.select(F.col("node").alias("a"), F.col("other").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
        out = components(links.union(verified(rest)))
    return out


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.8,
                         size: int = 5, by: str = "runs") -> DataFrame:
    """The rows of ``docs`` with one row of each group of near copies.

    Texts are linked where the Jaccard similarity of their sets of runs of ``size`` words
    (ASCII lower case) is ``similarity`` or more, and groups are what is reachable over
    links. With ``by="runs"`` every such link between different groups is found; with
    ``by="marks"`` those between texts that have a SimHash fingerprint within 3 bits of some
    other text's. Runs are told apart by 64-bit hashes. A text of fewer words is one run.

    The smallest key of a group stays, among equal keys the smallest content hash. Rows
    without a key stay only where no row of the group has one; of repeated rows one stays;
    texts without words, null and empty ones included, are copies of each other; an empty
    table stays empty. Columns of any name may stand beside key and text.
    """
    names = docs.columns
    own = {c: f"c{i}" for i, c in enumerate(names)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()])
    k, t = own[key], own[text]
    content = content_key(k, t)
    # texts without words are one text
    body = F.when(F.trim(F.translate(F.coalesce(F.col(t), F.lit("")), "\t\n\x0b\x0c\r", "     ")) == "", F.lit("")).otherwise(F.col(t))
    node = F.xxhash64(body).alias("node")
    marked, marked_path = stage(rows.select(F.col(k).alias("key"), content.alias("content"), node), "marked")
    roots, roots_path = near_links(rows.select(node, body.alias("text")), similarity, size, by)
    first = F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key", "content")).alias("first")
    groups = marked.groupBy("node").agg(first).join(roots, F.col("node") == F.col("u"), "left").groupBy(
        F.coalesce("root", "node").alias("group")).agg(F.min("first").alias("first"))
    chosen, _ = stage(groups.select(F.col("first.key").alias("chosen"), F.col("first.content").alias("chosen_content")).distinct(),
                      "chosen")
    for path in (marked_path, roots_path):
        remove(docs.sparkSession, path)
    kept = rows.withColumn("content", content).join(
        chosen, F.col(k).eqNullSafe(F.col("chosen")) & (F.col("content") == F.col("chosen_content")), "left_semi")
    return kept.dropDuplicates([k, "content"]).select(*[F.col(n).alias(c) for c, n in own.items()])
