import hashlib

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import winnowing as N

COLUMNS = "doc_id long, text string"


def brute(text, gram=N.GRAM, window=N.WINDOW):
    """Fingerprint as text and its set of hashes, window by window."""
    size = max(len(text) - gram + 1, min(len(text), 1))
    units = [xxhash.xxh64_intdigest(text[i:i + gram].encode("utf-32-be"), 42) >> 31 for i in range(size)]
    # as numbers of 33 bits with a sign
    signed = [u - (1 << 33) if u >= 1 << 32 else u for u in units]
    found = set()
    for start in range(max(size - window + 1, min(size, 1))):
        here = signed[start:start + window]
        found.add(start + max(i for i, v in enumerate(here) if v == min(here)))
    return " ".join(f"{p}:{units[p]:x}" for p in sorted(found)), {units[p] for p in found}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(texts):
    """By key: the fields of the result, for texts with distinct keys."""
    keys, out = sorted(texts), {}
    for key, after in zip(keys, keys[1:] + keys[:1]):
        text, n = texts[key], len(texts[key])
        edited = text[:n - n // 2] + texts[after][:n // 2]
        (own, a), (other, b), (_, c) = brute(text), brute(edited), brute(texts[after])
        out[key] = (n, hashlib.sha256(edited.encode()).hexdigest(), own, other, jaccard(a, b), jaccard(a, c))
    return out


def result(rows):
    return {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
            for r in rows.collect()}


ODD = {-1: "", 1000: "ab", 1002: "é ñ ß " * 30, 1003: "x" * 200, 1004: "a", 1005: "😀 smile " * 12, 1006: "ab" * 30}


@pytest.mark.parametrize("blocks", [1, 7])
def test_equals_brute_force(spark, documents, texts, blocks):
    chosen = {i: t for i, t in texts.items() if len(t) < 4000}
    given = documents.select("doc_id", "text").where(F.length("text") < 4000)
    rows = given.union(spark.createDataFrame(list(ODD.items()), COLUMNS))
    assert result(N.fingerprint_pairs(rows, blocks=blocks)) == expected({**chosen, **ODD})


def test_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(N, "PIECE", 100)
    long = {1: " ".join(str(i * i % 977) for i in range(1500)), 2: "short", 3: "ab" * 700}
    assert result(N.fingerprint_pairs(spark.createDataFrame(list(long.items()), COLUMNS), blocks=2)) == expected(long)


def test_rightmost_of_equal_hashes(spark):
    found = N.fingerprints(spark.createDataFrame([(1, "x" * 80)], COLUMNS)).select(N.spelled(F.col("picks")).alias("f")).first().f
    # 57 equal runs: the last of each of the 26 windows
    assert [int(p.split(":")[0]) for p in found.split()] == list(range(N.WINDOW - 1, 57))


def test_shared_passages_share_a_pick(spark):
    passage = "".join(chr(97 + i * i % 23) for i in range(N.GRAM + N.WINDOW - 1))
    rows = spark.createDataFrame([(i, "q" * (7 * i) + passage + str(i) * 60) for i in range(1, 8)], COLUMNS)
    sets = [set(r.h) for r in N.fingerprints(rows).select(N.hashes(F.col("picks")).alias("h")).collect()]
    assert all(a & b for a in sets for b in sets)


def test_odd_rows(spark, odd, empty):
    rows = N.fingerprint_pairs(odd).collect()
    assert len(rows) == odd.count()
    assert N.fingerprint_pairs(empty).count() == 0
    copies = [r for r in rows if r.doc_id == 4]
    # a repeated row is next to its copy
    assert max(r.near_next for r in copies) == 1.0 and len({r.fingerprint for r in copies}) == 1
    blank = [r for r in rows if r.doc_id == 2][0]
    assert (blank.n_chars, blank.fingerprint) == (0, "")
    one = N.fingerprint_pairs(odd.where("doc_id = 3")).first()
    assert (one.near_next, one.near_edited) == (1.0, 0.0)


def test_no_python_and_one_shuffle_of_texts(spark, documents):
    plan = N.fingerprint_pairs(documents, blocks=4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
