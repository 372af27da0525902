import collections
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.llm import packing as P

PIECES = st.lists(st.tuples(st.integers(1, 12), st.sampled_from([None, "a", "b"]), st.sampled_from([None, 1, 2, 3])), max_size=40)


@settings(max_examples=150, deadline=None)
@given(PIECES, st.integers(1, 2))
def test_each_piece_takes_the_tightest_compatible_bin(pieces, slots):
    capacity, bins, plain = 12, P.Bins(12, slots), []
    for size, source, cluster in sorted(pieces, key=lambda p: -p[0]):
        fits = [n for n, (room, sources, clusters) in enumerate(plain)
                if room >= size and (source is None or sources[source] < slots) and (cluster is None or cluster not in clusters)]
        best = min((plain[n][0] for n in fits), default=capacity)
        number, start = bins.put(size, source, cluster)
        assert capacity - start == best and (number in fits or not fits and number == len(plain))
        if number == len(plain):
            plain.append([capacity, collections.Counter(), set()])
        plain[number][0] -= size
        plain[number][1][source] += 1
        plain[number][2].add(cluster)


def check(rows, capacity, slots):
    by_bin = collections.defaultdict(list)
    for r in rows:
        by_bin[r.bin_id].append(r)
    for held in by_bin.values():
        at = 0
        for r in sorted(held, key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens
        assert at <= capacity
        sources = collections.Counter(r.source for r in held if r.source is not None)
        clusters = collections.Counter(r.cluster for r in held if r.cluster is not None)
        assert max(sources.values(), default=0) <= slots and max(clusters.values(), default=0) <= 1


@pytest.mark.parametrize("block_rows", [20_000, 150])
def test_nothing_is_lost_and_no_rule_broken(spark, block_rows):
    rng = random.Random(9)
    rows = [(i, rng.choice([1, 5, 40, 90, 250, 1000]), "hot" if rng.random() < 0.4 else f"s{rng.randint(0, 9)}",
             7 if rng.random() < 0.3 else None) for i in range(600)]
    pieces = spark.createDataFrame(rows, "row long, size long, source string, cluster long")
    placed = P.pack(pieces, 100, 2, block_rows).join(pieces.select("row", "source", "cluster"), "row").collect()
    assert {r: sum(p.n_tokens for p in placed if p.row == r) for r, *_ in rows} == {r: s for r, s, *_ in rows}
    check(placed, 100, 2)


def test_documents(documents, texts):
    source = {r.doc_id: r.source for r in documents.select("doc_id", "source").collect()}
    placed = P.pack_documents(documents, capacity=300).collect()
    words = collections.Counter()
    for r in placed:
        words[r.doc_id] += r.n_tokens
    assert words == {i: len(t.split()) + 1 for i, t in texts.items()}
    by_bin = collections.defaultdict(collections.Counter)
    for r in placed:
        by_bin[r.bin_id][source[r.doc_id]] += 1
    assert max(max(c.values()) for c in by_bin.values()) <= 2


def test_texts_are_cut_at_words(documents, texts):
    pieces = P.packed_texts(documents, capacity=100).collect()
    whole = collections.defaultdict(dict)
    for r in pieces:
        whole[r.doc_id][r.piece] = r
    assert whole.keys() == texts.keys()
    for i, parts in whole.items():
        assert "".join(parts[p].text for p in sorted(parts)) == texts[i]
        assert all(len(parts[p].text.split()) == 100 for p in sorted(parts)[:-1])


def test_bad_limits(spark):
    with pytest.raises(ValueError):
        P.pack(spark.createDataFrame([], "row long, size long, source string, cluster long"), 0)


def test_odd_rows(odd, empty):
    placed = P.pack_documents(odd.withColumnRenamed("key", "row"), capacity=1000)
    assert placed.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).where("doc_id = 5").first().n == 30_001
    assert placed.where("piece = 0").count() == odd.count()
    # the three equal texts are copies of each other
    copies = placed.where("n_tokens = 4").collect()
    assert len(copies) == 3 and len({r.bin_id for r in copies}) == 3
    texts = P.packed_texts(odd, capacity=1000)
    assert texts.where("doc_id = 5").agg(F.sum(F.length("text"))).first()[0] == 150_000
    assert texts.where("doc_id = 2 AND text = ''").count() == 1
    assert P.pack_documents(empty).count() == 0 and P.packed_texts(empty).count() == 0
