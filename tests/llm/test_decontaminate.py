import random
import time

import numpy as np
import pytest
import xxhash

from millrace.llm import decontaminate as D


def test_marks_equal_brute_force():
    rng = random.Random(5)
    words = [rng.choice("abcdefgh").encode() for _ in range(400)]
    hashes = D.Hashes().of(words)
    for size, longest in ((1, 50), (7, 50), (300, 300)):
        marks = D.window_marks(D.running_counts(hashes, longest), size)
        assert len(marks) == 400 - size + 1
        for i in (0, 13, len(marks) - 1):
            counts = [sum(xxhash.xxh32_intdigest(w) >> b & 1 for w in words[i:i + size]) for b in range(32)]
            assert marks[i] == sum(1 << b for b in range(32) if 2 * counts[b] > size)


@pytest.mark.parametrize("radius", [0, 3, 6, 7])
def test_blocks_find_all_within_the_radius(radius):
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("abcd", k=2)) for _ in range(12)) for _ in range(30)]
    items = D.Items(list(range(30)), texts, radius, 5, 0.8)
    words = [w for t in texts for w in t.encode().split()] * 20
    rng.shuffle(words)
    counts = D.running_counts(D.Hashes().of(words), items.longest)
    windows, marks = D.window_marks(counts, 12), items.sizes[12][1].marks
    expected = {(i, j) for i, w in enumerate(windows.tolist()) for j, m in enumerate(marks.tolist()) if (w ^ m).bit_count() <= radius}
    found = list(zip(*items.candidates(counts, 12)))
    assert {(i, j) for i, j, _ in found} == expected and len(found) == len(expected) and (expected or radius == 0)


def test_every_copied_item_is_found(spark, documents, texts):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = {r.item_id: D.words_of(r.text) for r in benchmark.collect()}
    found = {(r.doc_id, r.item_id): r for r in D.find_leaks(documents, benchmark).collect()}
    held = lambda text, item: any(text[i:i + len(item)] == item for i in range(len(text) - len(item) + 1))
    expected = {(d, i) for d, t in texts.items() for w in [D.words_of(t)] for i, item in items.items() if held(w, item)}
    assert {k for k, r in found.items() if r.similarity == 1.0} == expected and expected
    for (d, i), r in found.items():
        window = D.words_of(texts[d])[r.first_word:r.first_word + r.n_words]
        assert D.weighted_jaccard(D.shingles(window, 5), D.shingles(items[i], 5)) == r.similarity >= 0.8


@pytest.mark.parametrize("low, high", [(10, 19), (20, 29), (30, 39), (40, 59), (60, 120)])
def test_recall_of_changed_copies(low, high):
    """One word replaced, in every place: of the copies that the exact rule accepts 0.9 at least are found, for every size."""
    rng = random.Random(low)
    vocabulary = ["".join(rng.choices("abcdefghijklm", k=rng.randint(2, 7))) for _ in range(3000)]
    draw = lambda n: [vocabulary[int(rng.paretovariate(0.7)) % 3000] for _ in range(n)]
    items = [draw(rng.randint(low, high)) for _ in range(60)]
    built = D.Items(list(range(60)), [" ".join(i) for i in items], None, 5, 0.8)
    due = hits = 0
    for n, item in enumerate(items):
        exact = D.shingles(D.words_of(" ".join(item)), 5)
        texts = []
        for place in range(len(item)):
            changed = [*item[:place], f"changed{place}", *item[place + 1:]]
            if D.weighted_jaccard(D.shingles(D.words_of(" ".join(changed)), 5), exact) >= 0.8:
                texts.append(" ".join(draw(60) + changed + draw(60)))
        found = D.leaks(texts, built, D.Hashes(), 0.8)
        due += len(texts)
        hits += sum(any(f[0] == n for f in row) for row in found)
    assert due > 30 and hits >= 0.9 * due


def test_time_is_linear_with_many_items_of_a_size():
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    texts = [" ".join(word() for _ in range(50)) for _ in range(5000)]
    items = D.Items(list(range(5000)), texts, None, 5, 0.8)
    planted = rng.sample(range(5000), 20)
    some = [" ".join([*(word() for _ in range(900)), texts[i], *(word() for _ in range(900))]) for i in planted]
    took = []
    for many in (1, 4):
        started = time.process_time()
        rows = D.leaks(some * many, items, D.Hashes(), 0.8)
        took.append(time.process_time() - started)
        assert [{f[0] for f in row} for row in rows] == [{i} for i in planted] * many
    # a window meets the few items that share half a mark with it, not all of them
    compared = sum(len(half[1]) for half in items.sizes[50][1].halves) / 65_536
    assert compared < 25 and took[1] < 8 * took[0] + 1


def test_shingles_are_weighted():
    a, b = D.shingles(b"x x x y".split(), 1), D.shingles(b"x y y".split(), 1)
    assert D.weighted_jaccard(a, b) == 2 / 5 and D.weighted_jaccard(a, a) == 1.0
    assert D.weighted_jaccard(D.shingles([], 5), D.shingles([], 5)) == 0.0


def test_odd_rows(spark, odd, empty):
    benchmark = spark.createDataFrame([("a", "One, two THREE"), ("b", None), ("c", " ?! "), ("a", "One, two THREE"), (None, "é ñ ß é")],
                                      "item_id string, text string")
    found = sorted(map(str, D.find_leaks(odd, benchmark).select("doc_id", "item_id").collect()))
    # windows of one item that overlap count once
    assert len(found) == 3 + 2 and sum("'a'" in f for f in found) == 3
    kept = D.drop_leaks(odd.withColumnRenamed("key", "leaks"), benchmark)
    assert kept.columns == [*odd.columns[:-1], "leaks"]
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 5]
    assert D.find_leaks(empty, benchmark).count() == 0
    assert D.drop_leaks(odd, benchmark.limit(0)).count() == odd.count()


def test_a_benchmark_in_blocks_gives_the_same(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole, parts = (sorted(map(tuple, D.find_leaks(documents, benchmark, block_words=n).collect())) for n in (10**6, 400))
    assert whole == parts and whole


def test_a_key_called_like_a_field(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    found = D.find_leaks(documents.withColumnRenamed("doc_id", "item_id"), benchmark, key="item_id")
    assert found.columns == ["item_id", "item_id_", "first_word", "n_words", "similarity", "distance"] and found.count() > 0


def test_long_texts_are_groups_of_their_own(monkeypatch):
    monkeypatch.setattr(D, "GROUP_WORDS", 50)
    item = "alpha beta gamma delta epsilon zeta"
    texts = ["x " * 500 + item, None, item, "", item + " y" * 100 + " " + item]
    rows = D.leaks(texts, D.Items([1], [item], None, 5, 0.8), D.Hashes(), 0.8)
    assert [[f[1] for f in row] for row in rows] == [[500], [], [0], [], [0, 106]]
    assert np.all([f[3] == 1.0 for row in rows for f in row])
