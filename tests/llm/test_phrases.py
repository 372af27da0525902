import re
from collections import Counter, defaultdict

import pytest

import oracle
from millrace.llm import phrases as P
from millrace.llm.catalog import queries

COLUMNS = "lang string, text string"


def brute(rows, longest=3, least=10, share=50, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, folded = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            longer = [b for q, b in candidates.items() if len(q) > len(p)
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= share * a for b in longer):
                continue
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), a, left, right))
        for rank, (score, _, phrase, a, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, total[lang], -score))
    return sorted(out)


def result(found):
    return sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    assert oracle.differences(spark, oracle.duck(folder), queries()["op13_phrases"], folder) is None


TEXTS = [("en", "New York city, new YORK\tcity. New york! state\nnew york"), ("en", "of the of the of the of the"), ("en", None),
         (None, "a b c d a b c d; a b c d"), ("und", "a b c d"), ("fr", " \t..,, "), ("en", ""), ("en", "nbsp joins words nbsp joins words"),
         ("en", "of the of the of the of the")]


@pytest.mark.parametrize("longest", [2, 3, 4])
@pytest.mark.parametrize("least", [1, 3])
def test_equals_brute_force(spark, longest, least, monkeypatch):
    # small chunks and slices, so that phrases meet only in the shuffle
    monkeypatch.setattr(P, "CHUNK_WORDS", 5)
    monkeypatch.setattr(P, "CHUNK_BYTES", 7)
    rows = spark.createDataFrame(TEXTS, COLUMNS).repartition(3)
    assert result(P.collocations(rows, longest=longest, least=least)) == brute(TEXTS, longest, least)
    assert result(P.collocations(rows, longest=longest, least=least, top=2)) == brute(TEXTS, longest, least, top=2)


def test_products_beyond_64_bits(spark):
    many = [("x", "p q. " * 60_000)] * 60
    found = P.collocations(spark.createDataFrame(many, COLUMNS)).first()
    assert (found.a, found.score, found.n) == (3_600_000, 1_000_000, 7_200_000)


def test_odd_rows(spark, odd, empty):
    found = P.collocations(odd.withColumnRenamed("source", "lang"), least=2)
    assert {r.lang for r in found.collect()} == {"s", "und", "long"} - {"und"}
    assert P.collocations(empty.withColumnRenamed("source", "lang")).count() == 0
    with pytest.raises(ValueError):
        P.collocations(odd, longest=1)


def test_hashes_that_meet_are_told_apart(spark, monkeypatch):
    whole = P.xxhash.xxh64_intdigest
    # under the first seed all words share a hash
    monkeypatch.setattr(P._Counter, "hashes", lambda self, seed: P.np.array(
        [0] + [7 if seed == 0 else whole(w, seed) % 2 ** 62 for w in list(self.words)[1:]], P.np.int64))
    rows = spark.createDataFrame(TEXTS, COLUMNS)
    assert result(P.collocations(rows, least=1)) == brute(TEXTS, 3, 1)


def test_one_shuffle_of_windows(spark, documents):
    counts = P.phrase_counts(documents.select("lang", "text"), 3, 10, 0)
    counts.collect()
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "Expand" in plan


@pytest.mark.parametrize("wide", [False, True])
def test_distinct_rows(wide):
    rng = P.np.random.default_rng(3)
    columns = [rng.integers(0, n, 500).astype(P.np.int32) for n in (2, 5, 9)]
    found, uses = P._distinct(columns, [2 ** 30] * 3 if wide else [2, 5, 9])
    expected = Counter(zip(*(c.tolist() for c in columns)))
    assert dict(zip(zip(*(c.tolist() for c in found)), uses.tolist())) == expected
    none, uses = P._distinct([c[:0] for c in columns], [2 ** 30] * 3 if wide else [2, 5, 9])
    assert [len(c) for c in none] == [0, 0, 0] and len(uses) == 0
