"""Line deduplication by content-defined chunks of lines, in DataFrame functions only.

A hash rolls over the hashes of the last lines of a text; where it is divisible by
``every`` a chunk ends. The cut depends on those lines alone, so a passage that
stands in two texts is cut alike in both, whatever precedes it. Chunks of two or
more lines that occur again anywhere are compared as bytes with their first
occurrence and removed where they are equal.

Such chunks are too coarse for passages of a few lines: a cut beside a passage hangs
on the foreign line next to it. ``passages_of`` therefore gives every run of two lines
with words, and every long line by itself, so that all repeated passages of two lines,
or of one long line, are found whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.staging import stage
from millrace.llm.words import content_key


#: Words of a line that is a passage by itself.
PASSAGE = 50


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it, also inside other functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def chunk_starts(lines: Column, roll: int, every: int) -> Column:
    """Numbers of the lines that start a chunk: the first, and those that follow an end."""
    hashes = F.transform(lines, lambda line: F.xxhash64(line))

    if roll == 1:
        marks = F.transform(hashes, lambda h: F.xxhash64(h))
    elif roll == 2:
        marks = let(hashes, lambda h: F.zip_with(F.concat(F.array(F.lit(None).cast("bigint")), h), h,
                                                 lambda old, new: F.xxhash64(old, new)))
    else:
        raise ValueError("one or two lines are rolled over")
    # marks[i] covers the lines up to i; a hash over fewer lines than ``roll`` ends nothing
    ends = F.transform(marks, lambda mark, i: F.when((i >= roll - 1) & (F.pmod(mark, F.lit(every)) == 0), i + 1))
    inner = F.filter(ends, lambda i: i.isNotNull() & (i < F.size(lines)))
    return F.concat(F.array(F.lit(0)), inner)


def chunks_of(text: Column, roll: int = 2, every: int = 4) -> Column:
    """array<struct<first, lines>>: the chunks of ``\\n``-separated lines, ``first`` from 0."""
    def cut(lines: Column, starts: Column) -> Column:
        return F.transform(starts, lambda first, n: F.struct(
            first.alias("first"),
            F.slice(lines, first + 1, F.coalesce(F.get(starts, n + 1), F.size(lines)) - first).alias("lines")))
    return let(F.split(text, "\n", -1), lambda lines: let(
        chunk_starts(lines, roll, every), lambda starts: cut(lines, starts)))


def _words(line: Column) -> Column:
    """Number of words of a line."""
    return F.size(F.filter(F.split(line, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != ""))


def passages_of(text: Column, size: int, alone: int) -> Column:
    """array<struct<first, lines>>: all runs of ``size`` lines with words, and all lines of ``alone`` words or more.

    Lines without words between those of a run belong to it but do not count, so a line
    between two blank ones is no passage.
    """
    def runs(lines: Column, worded: Column) -> Column:
        starts = F.filter(F.transform(worded, lambda line, n: n), lambda n: n + size <= F.size(worded))
        return F.transform(starts, lambda n: F.struct(F.get(worded, n).alias("first"), F.slice(
            lines, F.get(worded, n) + 1, F.get(worded, n + size - 1) - F.get(worded, n) + 1).alias("lines")))

    def singles(lines: Column, worded: Column) -> Column:
        # so many words have blanks between them, or rarer characters, which is cheap to rule out
        def may(line: Column) -> Column:
            blanks = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
            return (blanks >= alone - 1) | F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\r")) | F.contains(
                line, F.lit("\x0b")) | F.contains(line, F.lit("\x0c"))
        long = F.filter(worded, lambda i: F.when(F.octet_length(F.get(lines, i)) < 2 * alone - 1, False).when(
            may(F.get(lines, i)), _words(F.get(lines, i)) >= alone).otherwise(False))
        return F.transform(long, lambda i: F.struct(i.alias("first"), F.array(F.get(lines, i)).alias("lines")))
    return let(F.split(text, "\n", -1), lambda lines: let(
        F.filter(F.transform(lines, lambda line, i: i), lambda i: F.octet_length(F.ltrim(F.get(lines, i), F.lit(" \t\x0b\x0c\r"))) > 0),
        lambda worded: F.concat(runs(lines, worded), singles(lines, worded))))


def repeated_chunks(rows: DataFrame, text: str, identity: list[str], chunks: Column, wanted: Column) -> DataFrame:
    """(identity, first, size) of every repeated chunk but its first occurrence, by the order of ``identity`` and place.

    Chunks may overlap; one that overlaps its own first occurrence is left out.
    """
    exploded = rows.where(F.col(text).isNotNull()).select(*identity, F.explode(chunks).alias("chunk"))
    exploded = exploded.where(wanted & F.exists("chunk.lines", lambda line: F.length(F.trim(line)) > 0))
    size = F.size("chunk.lines")
    place = F.struct(*[F.col(c) for c in identity], F.col("chunk.first").alias("first"))
    marked = exploded.select(place.alias("place"), F.xxhash64(F.array_join("chunk.lines", "\n"), size).alias("hash"), size.alias("size"))
    # places and hashes alone are counted; the few repeated ones then fetch the chunks themselves from the texts
    repeated, _ = stage(marked.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("origin"))
                        .where("n > 1").select("hash", "origin"), "repeated")
    # a merge join at every size: what repeats grows with the texts, and adaptive execution may split a hot hash
    found = marked.join(repeated.hint("merge"), "hash")
    within = F.lit(True)
    for c in identity:
        within = within & F.col(f"place.{c}").eqNullSafe(F.col(f"origin.{c}"))
    first = F.col("place").eqNullSafe(F.col("origin"))
    found = found.where(first | ~within | (F.col("place.first") >= F.col("origin.first") + F.col("size")))
    lists = found.groupBy(*[F.col(f"place.{c}").alias(f"own_{c}") for c in identity]).agg(
        F.collect_set(F.struct("place.first", "size", "hash", first.alias("origin"))).alias("found"))
    same = F.lit(True)
    for c in identity:
        same = same & F.col(c).eqNullSafe(F.col(f"own_{c}"))
    fetched = rows.join(lists.hint("merge"), same).select(*identity, F.explode(let(
        F.split(F.col(text), "\n", -1), lambda lines: F.transform("found", lambda c: F.struct(
            c["first"].alias("first"), c["size"].alias("size"), c["hash"].alias("hash"), c["origin"].alias("origin"),
            F.array_join(F.slice(lines, c["first"] + 1, c["size"]), "\n").alias("body"))))).alias("c")).select(*identity, "c.*")
    candidates, _ = stage(fetched, "candidates")
    origins = candidates.where("origin").groupBy("hash").agg(F.max("body").alias("first_body"))
    origins, _ = stage(origins, "origins")
    return (candidates.where("NOT origin").join(origins.hint("merge"), "hash")
            .where(F.col("body") == F.col("first_body")).select(*identity, "first", "size"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_lines: int = 2, roll: int = 2,
                every: int = 4, removed_into: str | None = None, alone: int | None = None) -> DataFrame:
    """``docs`` without repeated chunks of ``min_lines`` lines or more; the first occurrence stays.

    With ``alone``, chunks are all runs of ``min_lines`` lines with words, blank lines
    between them included, and all single lines of ``alone`` words or more, so every
    repeated passage of such a size goes, wherever it stands; ``roll`` and ``every`` are
    not used then.

    All rows and columns stay, also where nothing is left of a text (it is then
    empty). First is the smallest key (null last), then content hash, then place.
    Rows equal in key and text are one document: what one keeps, all keep. Null and
    empty texts are unchanged, blank chunks stay, an empty table stays empty. With
    ``removed_into``, a column of that name tells the number of lines removed.
    Columns of any name may stand beside key and text.
    """
    names = docs.columns
    own = {c: f"c{i}" for i, c in enumerate(names)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()])
    k, t = own[key], own[text]
    rows = rows.withColumns({"unnamed": F.col(k).isNull(), "content": content_key(k, t)})
    if alone is None:
        chunks, wanted = chunks_of(F.col("text"), roll, every), F.size("chunk.lines") >= min_lines
    else:
        chunks, wanted = passages_of(F.col("text"), min_lines, alone), F.lit(True)
    numbers = F.sequence("first", F.col("first") + F.col("size") - 1)
    gone = (repeated_chunks(rows.select("unnamed", F.col(k).alias("key"), "content", F.col(t).alias("text")), "text",
                            ["unnamed", "key", "content"], chunks, wanted)
            .select("key", "content", F.explode(numbers).alias("line"))
            .groupBy("key", "content").agg(F.collect_set("line").alias("gone")))
    gone, _ = stage(gone.withColumnRenamed("content", "gone_content"), "gone")
    found = rows.join(gone.hint("merge"), F.col(k).eqNullSafe(gone["key"]) & (F.col("content") == F.col("gone_content")), "left")
    kept = let(F.split(F.col(t), "\n", -1), lambda lines: F.array_join(F.transform(
        F.array_except(F.transform(lines, lambda line, i: i), "gone"), lambda i: F.get(lines, i)), "\n"))
    changed = F.when(F.col("gone").isNull(), F.col(t)).otherwise(kept)
    found = found.withColumns({"new": changed})
    removed = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint")
    out = [F.col("new" if n == t else n).alias(c) for c, n in own.items() if c != removed_into]
    return found.select(*out, *([removed.alias(removed_into)] if removed_into else []))


def _query(spark, folder):
    from millrace.llm.catalog import table
    return dedup_lines(table(spark, folder, "documents").select("doc_id", "text"), removed_into="n_removed", alone=PASSAGE)


QUERIES = {"op10_line_chunks": (_query, None)}
