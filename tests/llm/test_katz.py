import collections
import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.llm import katz as K


def histogram(counter):
    return [0, *(sum(1 for c in counter.values() if c == r) for r in range(1, K.KATZ + 2)),
            sum(1 for c in counter.values() if c > K.KATZ + 1)]


class Plain:
    """The model with plain dictionaries."""

    def __init__(self, texts):
        self.words, self.pairs = collections.Counter(), collections.Counter()
        for words in texts:
            self.words.update(words)
            self.pairs.update(zip([K.START, *words], words))
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.dw, self.dp = K.discounts(histogram(self.words)), K.discounts(histogram(self.pairs))
        factor = lambda d, c: d[min(c, K.KATZ + 1)] * c
        kept = sum(factor(self.dw, c) for c in self.words.values())
        freed = any(c <= K.KATZ for c in self.words.values())
        self.whole = self.n if freed else self.n + 1
        self.unmet = 1 - kept / self.whole
        self.count, self.free, self.lower = collections.Counter(), collections.Counter(), collections.Counter()
        for (v, w), c in self.pairs.items():
            self.count[v] += c
            self.free[v] += c - factor(self.dp, c)
            self.lower[v] += self.word(w)

    def word(self, w):
        c = self.words[w]
        return self.dw[min(c, K.KATZ + 1)] * c / self.whole if c else self.unmet

    def pair(self, v, w):
        if not self.count[v]:
            return self.word(w)
        free = self.free[v] > 1e-12
        whole = self.count[v] if free else self.count[v] + 1
        c = self.pairs[v, w]
        if c:
            return self.dp[min(c, K.KATZ + 1)] * c / whole
        return (self.free[v] if free else 1) / whole / (1 - self.lower[v]) * self.word(w)


def split(text):
    return [*(text or "").encode().lower().split(), K.END]


HELD = "crc32(string(doc_id)) % 10 = 0"


@pytest.mark.parametrize("block_bytes", [16_000_000, 40_000])
def test_scores_equal_plain_model(documents, texts, monkeypatch, block_bytes):
    monkeypatch.setattr(K, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(K, "BUCKET_KEYS", block_bytes)
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    model = Plain(split(t) for i, t in texts.items() if not held[i])
    found = {r.doc_id: r for r in K.katz_scores(documents, F.expr(HELD)).collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        words, r = split(text), found[i]
        base = sum(math.log10((model.words[w] + 0.1) / (model.n + 0.1 * (model.v + 1))) for w in words)
        score = sum(math.log10(model.pair(v, w)) for v, w in zip([K.START, *words], words))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            held[i], len(words), sum(model.words[w] > 0 for w in words), model.n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)
    assert sum(r.score for r in found.values() if r.held_out) > sum(r.base_score for r in found.values() if r.held_out)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=15), min_size=1, max_size=12))
def test_plain_model_adds_up_to_one(texts):
    model = Plain([*t, K.END] for t in texts)
    every = [*model.words, b"unmet"]
    assert math.isclose(sum(map(model.word, every)), 1)
    for v in [K.START, b"unmet", *model.words]:
        assert math.isclose(sum(model.pair(v, w) for w in every), 1), v


def test_discounts():
    falling = [0, 1000, 400, 200, 110, 70, 45, 300]
    found = K.discounts(falling)
    cut = 6 * 45 / 1000
    assert math.isclose(found[1], (2 * 400 / 1000 - cut) / (1 - cut)) and found[6] == 1
    # with a gap one absolute discount
    assert K.discounts([0, 10, 5, 0, 0, 0, 0, 0])[1] == 1 - 10 / 20
    assert K.discounts([0] * 8)[1] == 0.5


def test_keys_survive_packing():
    keys = np.unique(np.random.default_rng(1).integers(0, 2 ** 64, 1000, np.uint64))
    assert (K.unpack_keys(K.pack_keys(keys), len(keys)) == keys).all()
    parts = list(K.by_bucket(keys, 7))
    assert parts[0][1] == 0 and parts[-1][2] == len(keys) and all(a[2] == b[1] for a, b in zip(parts, parts[1:]))


def test_odd_rows(odd, empty):
    found = K.katz_scores(odd, F.col("doc_id") == 6)
    rows = found.collect()
    assert len(rows) == odd.count() and sum(r.held_out for r in rows) == 1
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert K.katz_scores(empty, F.lit(False)).count() == 0
    untrained = K.katz_scores(odd, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 for r in untrained)
