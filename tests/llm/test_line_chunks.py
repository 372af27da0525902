import random
import struct

import xxhash
from pyspark.sql import functions as F

from millrace.llm import line_chunks as C


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def cut(text, roll=2, every=4):
    lines = text.split("\n")
    hashes = [signed(xxhash.xxh64_intdigest(x.encode(), 42)) for x in lines]
    firsts = [0]
    for i in range(1, len(lines)):
        if i >= roll:
            seed = 42
            for h in hashes[i - roll:i]:
                seed = xxhash.xxh64_intdigest(struct.pack("<q", h), seed)
            if signed(seed) % every == 0:
                firsts.append(i)
    return [(a, lines[a:b]) for a, b in zip(firsts, [*firsts[1:], len(lines)])]


def brute(texts, min_lines=2):
    """Texts by id without repeated chunks."""
    seen, out = {}, {}
    for i in sorted(texts):
        kept = []
        for first, lines in cut(texts[i]):
            body = "\n".join(lines)
            if len(lines) >= min_lines and any(x.strip(" ") for x in lines) and (body, len(lines)) in seen:
                continue
            seen.setdefault((body, len(lines)), (i, first))
            kept += lines
        out[i] = "\n".join(kept)
    return out


def test_chunks_equal_brute_force(documents, texts):
    rows = documents.select("doc_id", C.chunks_of(F.col("text")).alias("c")).collect()
    for r in rows:
        assert [(x.first, x.lines) for x in r.c] == cut(texts[r.doc_id])


def test_documents_equal_brute_force(documents, texts):
    found = {r.doc_id: r.text for r in C.dedup_lines(documents).collect()}
    expected = brute(texts)
    assert found == expected and found != texts


def test_a_shifted_passage_is_found(spark):
    rng = random.Random(8)
    line = lambda: "".join(rng.choices("abcdefgh ", k=40))
    passage = [line() for _ in range(40)]
    texts = {i: "\n".join([line() for _ in range(i + 3)] + passage + [line() for _ in range(5)]) for i in range(4)}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    found = {r.doc_id: r for r in C.dedup_lines(df, removed_into="gone").collect()}
    assert found[0].gone == 0 and all(found[i].gone > 15 for i in (1, 2, 3))
    assert {i: r.text for i, r in found.items()} == brute(texts)
    for i, r in found.items():
        assert set(texts[i].split("\n")) - set(r.text.split("\n")) <= set(passage)


def test_main_path_has_no_python(documents):
    plan = C.dedup_lines(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(odd, empty, spark):
    found = C.dedup_lines(odd, removed_into="content")
    assert found.count() == odd.count() and set(found.columns) == set(odd.columns)
    assert sorted(map(str, found.select("doc_id", "text").collect())) == sorted(map(str, odd.select("doc_id", "text").collect()))
    assert C.dedup_lines(empty).columns == empty.columns and C.dedup_lines(empty).count() == 0
    block = "\n".join(f"line {i}" for i in range(12))
    rows = [(2, block), (1, block), (1, block), (None, block), (3, "\n\n\n"), (4, "\n\n\n")]
    texts = sorted(((r.doc_id or 9), r.text) for r in C.dedup_lines(spark.createDataFrame(rows, "doc_id int, text string")).collect())
    assert [t for i, t in texts if i == 1] == [block, block] and [t for i, t in texts if i in (3, 4)] == ["\n\n\n"] * 2
    assert all(len(t) < len(block) for i, t in texts if i in (2, 9))


def test_short_planted_passages_go(spark):
    rng = random.Random(21)
    line = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    passages = [[line(60)], [line(27), line(27)], [line(20), line(9), line(30)], [line(12) for _ in range(4)]] * 5
    texts, left = {}, {}
    for i, passage in enumerate(passages):
        for n in range(2):
            own = [line(27) for _ in range(4)]
            texts[2 * i + n] = "\n".join([*own[:2], *passage, *own[2:]])
            left[2 * i + n] = texts[2 * i + n] if i < 4 and n == 0 else "\n".join(own)
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    assert {r.doc_id: r.text for r in C.dedup_lines(df, alone=50).collect()} == left


def test_overlaps_and_short_lines_keep_their_first(spark):
    texts = {1: "a\na\na", 2: "b\nb\nb\nb", 3: "x\ny", 4: "x", 5: "\n\n\n"}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    found = {r.doc_id: (r.text, r.gone) for r in C.dedup_lines(df, alone=50, removed_into="gone").collect()}
    assert found == {1: ("a\na\na", 0), 2: ("b\nb", 2), 3: ("x\ny", 0), 4: ("x", 0), 5: ("\n\n\n", 0)}


def passages(text, alone=C.PASSAGE):
    """Runs of two lines with words, and lines of ``alone`` words: (first, lines)."""
    lines = text.split("\n")
    worded = [i for i, x in enumerate(lines) if x.split(" ") and x.strip(" \t\x0b\x0c\r")]
    return ([(a, lines[a:b + 1]) for a, b in zip(worded, worded[1:])]
            + [(i, lines[i:i + 1]) for i in worded if len(lines[i].encode().split()) >= alone])


def brute_passages(texts, alone=C.PASSAGE):
    """Texts by id without the lines of repeated passages; the first occurrence of each stays."""
    origin, out = {}, {}
    for i in sorted(texts):
        for first, lines in sorted(passages(texts[i], alone), key=lambda p: p[0]):
            origin.setdefault(tuple(lines), (i, first))
    for i, text in texts.items():
        gone = set()
        for first, lines in passages(text, alone):
            where = origin[tuple(lines)]
            if where != (i, first) and (where[0] != i or first >= where[1] + len(lines)):
                gone |= set(range(first, first + len(lines)))
        out[i] = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone)
    return out


def test_the_registered_form_equals_brute_force(documents, texts):
    found = {r.doc_id: r.text for r in C.dedup_lines(documents, alone=C.PASSAGE).collect()}
    expected = brute_passages(texts)
    assert found == expected and found != texts


def test_short_lines_between_blank_ones_stay(spark):
    texts = {1: "a text of its own\n\nThanks.\n\nclosing words", 2: "another text of its own\n\nThanks.\n\nclosing lines",
             3: "x\n\nThanks.\n \t\nBye.\ny", 4: "z\nThanks.\n \t\nBye.\nq", 5: "Thanks."}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    found = {r.doc_id: r.text for r in C.dedup_lines(df, alone=50).collect()}
    # a passage of two lines with a blank one between goes whole
    assert found == {**texts, 4: "z\nq"} == brute_passages(texts)


def test_words_are_counted_not_blanks(spark):
    wide = "two" + " " * 200 + "words"
    texts = {1: f"a\n\n{wide}\n\nb", 2: f"c\n\n{wide}\n\nd"}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    assert {r.doc_id: r.text for r in C.dedup_lines(df, alone=50).collect()} == texts


def test_odd_rows_of_the_registered_form(odd, empty, spark):
    found = C.dedup_lines(odd, removed_into="content", alone=50)
    assert found.count() == odd.count() and set(found.columns) == set(odd.columns)
    assert sorted(map(str, found.select("doc_id", "text").collect())) == sorted(map(str, odd.select("doc_id", "text").collect()))
    assert C.dedup_lines(empty, alone=50).count() == 0
    block = "first line\nsecond line"
    rows = [(2, block), (1, block), (1, block), (None, block), (3, None), (4, "")]
    texts = sorted(((r.doc_id or 9), r.text or "") for r in C.dedup_lines(
        spark.createDataFrame(rows, "doc_id int, text string"), alone=50).collect())
    # equal rows are one document; the one without a key comes last
    assert texts == [(1, block), (1, block), (2, ""), (3, ""), (4, ""), (9, "")]
