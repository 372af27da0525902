"""Document fingerprints by winnowing, with DataFrame functions only.

Every run of ``GRAM`` code points is hashed, and of every ``WINDOW`` successive
runs the one with the smallest hash is picked, the rightmost of equal ones. Two
texts that share GRAM + WINDOW - 1 code points in a row share a pick, and a pick
says where it stands. A pick is one 64-bit number, the hash in the high 33 bits
and the position, counted backwards, in the low 31, so that the least number of
a window is its pick, ties included. Least numbers of windows come from doubling:
the least of 2s runs is the lesser of two leasts of s runs.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F

#: Code points of a run, and successive runs of which one is picked.
GRAM, WINDOW = 24, 32

#: Windows of a text that are worked on at a time.
PIECE = 16_384

#: The low bits of a pick hold this less the position.
_LAST = (1 << 31) - 1


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def picks(text: str, offset: str, least: str, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Picks of a text that starts at position ``offset``, in order of position.

    ``text``, ``offset`` and ``least`` are columns. A text of fewer runs than a window has
    ``least`` (0 or 1) windows, and one with fewer code points than ``gram`` is one run.
    """
    low, runs = f"p * {PIECE}", f"greatest(n - {gram - 1}, least(n, 1))"
    count = f"least({PIECE}, windows - p * {PIECE})"
    # position i of the piece is run p * PIECE + i of the text
    hashed = f"xxhash64(substring(units, 4 * i + 1 + 4 * {low}, {4 * gram}))"
    runs_here = f"least({runs}, {low} + {count} + {window - 1}) - {low}"
    found = (f"transform(sequence({_LAST}L - {offset} - {low}, {_LAST}L - {offset} - {low} - ({runs_here}) + 1, -1L), "
             f"(back, i) -> ({hashed} & {~_LAST}L) | back)")
    span = 1
    while span < window:
        step = min(span, window - span)
        # past the end the least of what is left stands
        found = _let("m", found, f"zip_with(m, slice(m, {1 + step}, size(m)), (a, b) -> if(b < a, b, a))")
        span += step
    piece = f"array_distinct(slice({found}, 1, {count}))"
    pieces = f"flatten(transform(sequence(0, (windows - 1) div {PIECE}), q -> {_let('p', 'int(q)', piece)}))"
    windows = f"greatest({runs} - {window - 1}, least({least}, n))"
    whole = _let("n", f"char_length({text})", _let("windows", windows, (
        f"if(windows > 0, {_let('units', f"encode({text}, 'UTF-32')", f'array_distinct({pieces})')}, array())")))
    return F.expr(whole)


def hashes(found: Column) -> Column:
    """Distinct hashes of picks."""
    return F.array_distinct(F.transform(found, lambda v: F.shiftrightunsigned(v, 31)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes; empty sets are alike."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def spelled(found: Column) -> Column:
    """Picks as text: position and hash (hexadecimal) of each."""
    return F.array_join(F.transform(found, lambda v: F.concat(
        (F.lit(_LAST) - v.bitwiseAND(F.lit(_LAST))).cast("string"), F.lit(":"), F.lower(F.hex(F.shiftrightunsigned(v, 31))))), " ")


def fingerprints(docs: DataFrame, text: str = "text", into: str = "picks") -> DataFrame:
    """``docs`` with an array ``into`` of the picks of each whole text; null texts are empty and have none."""
    name = "__text"
    return docs.withColumn(name, F.coalesce(F.col(text), F.lit(""))).withColumn(into, picks(name, "0", "1")).drop(name)


def _cuts(keys: DataFrame, blocks: int) -> list:
    """Smallest (key, tie) of each of about ``blocks`` ranges, in order; the first is the smallest of all."""
    ranged = keys.repartitionByRange(blocks, "key", "tie")
    firsts = ranged.groupBy(F.spark_partition_id()).agg(F.min(F.struct("key", "tie")).alias("cut"))
    return [r.cut for r in firsts.orderBy("cut").collect()]


def _block(at: Column, cuts: list, kind: str) -> tuple[Column, Column]:
    """Number of the range that ``at`` lies in, and its cut: every ``step``-th cut first, then those in between."""
    every = [F.struct(F.lit(c.key).cast(kind).alias("key"), F.lit(c.tie).cast("bigint").alias("tie")) for c in cuts]
    step = isqrt(len(cuts)) + 1
    whole, coarse = F.array(*every), F.array(*every[::step])
    start = (F.size(F.filter(coarse, lambda c: c <= at)) - 1) * step
    inside = F.size(F.filter(F.slice(whole, start + 1, F.lit(step)), lambda c: c <= at))
    block = (start + inside - 1).cast("int")
    return block, F.element_at(whole, block + 1)


def in_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """Rows (key, tie, text) dealt to ranges of (key, tie), with ``block`` and ``guest``.

    The first row of every range is also a guest at the end of the range before it, that
    of the first range of the last one, so a row and the one after it are in one block.
    Texts are shuffled once, and ``blocks`` cut points reach the driver.
    """
    cuts = _cuts(docs.select("key", "tie"), blocks) or [Row(key=None, tie=0)]
    number, cut = _block(F.struct("key", "tie"), cuts, dict(docs.dtypes)["key"])
    dealt = docs.withColumn("block", number).withColumn("leads", F.struct("key", "tie") == cut)
    here = F.struct("block", F.lit(False).alias("guest"))
    before = F.struct(((F.col("block") + len(cuts) - 1) % len(cuts)).cast("int").alias("block"), F.lit(True).alias("guest"))
    to = F.when(F.col("leads"), F.array(here, before)).otherwise(F.array(here))
    return dealt.select("key", "tie", "text", F.explode(to).alias("to")).select("key", "tie", "text", "to.*").repartition("block")


def fingerprint_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", blocks: int | None = None) -> DataFrame:
    """Fingerprints of every whole text, of its edited text, and how alike they and the next text are.

    The edited text is the text with its last floor(n / 2) code points replaced by the
    first as many of the next text by key (or all of it); the first follows the last.
    Columns: key, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``
    (position and hash of every pick), ``near_edited``, ``near_next`` (Jaccard similarity of
    the sets of hashes; two empty sets are alike).

    Null texts are empty and have an empty fingerprint; a text shorter than a run is one
    run. Null keys come first; rows of one key follow each other by the hash of their
    texts, and rows equal in both follow each other, so each is next to its copy. Other
    columns are left out; an empty table gives no rows. Windows that lie whole in the
    part of a text that the edit leaves are worked on once. Long texts are worked on in
    pieces of ``PIECE`` windows.
    """
    spark = docs.sparkSession
    blocks = blocks or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("key", F.xxhash64("text").alias("tie"), "text")
    sent = in_blocks(rows, blocks)
    # windows before ``common`` lie in the first ``left`` code points, which the edit leaves
    span = GRAM + WINDOW - 1
    own = sent.withColumn("n", F.char_length("text")).withColumn("left", F.col("n") - F.floor(F.col("n") / 2).cast("int"))
    own = own.withColumn("common", F.greatest(F.col("left") - (span - 1), F.lit(0)))
    own = own.withColumns({"kept": F.expr("if(common > 0, substring(text, 1, left), '')"), "rest": F.expr("substring(text, common + 1)"),
                           "alone": F.expr("int(common = 0)")})
    own = own.withColumns({"head": picks("kept", "0", "0"), "tail": picks("rest", "common", "alone")})
    own = own.withColumn("picks", F.array_distinct(F.concat("head", "tail"))).drop("kept", "rest", "tail")
    order = W.partitionBy("block").orderBy("guest", "key", "tie")
    paired = own.withColumns({"next_text": F.lead("text").over(order), "next_picks": F.lead("picks").over(order)}).where(~F.col("guest"))
    paired = paired.withColumn("edited", F.expr("concat(substring(text, 1, left), substring(next_text, 1, n - left))"))
    paired = paired.withColumn("rest", F.expr("substring(edited, common + 1)")).withColumn("edited_tail", picks("rest", "common", "alone"))
    paired = paired.withColumn("edited_picks", F.array_distinct(F.concat("head", "edited_tail")))
    paired = paired.withColumns({"own": hashes(F.col("picks")), "other": hashes(F.col("edited_picks")), "after": hashes(F.col("next_picks"))})
    return paired.select(
        F.col("key").alias(key), F.col("n").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        spelled(F.col("picks")).alias("fingerprint"), spelled(F.col("edited_picks")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("after")).alias("near_next"))


def _query(spark, folder):
    from millrace.llm.catalog import table
    return fingerprint_pairs(table(spark, folder, "documents").select("doc_id", "text"))


QUERIES = {"op11_winnowing": (_query, None)}
