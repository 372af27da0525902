import random

from hypothesis import given, settings, strategies as st

from millrace.llm import quality_rules as Q


def brute(words, window, shortest):
    longest = [max((next((k for k in range(len(words)) if i + k >= len(words) or j + k >= len(words)
                          or words[i + k] != words[j + k]), len(words)) for j in range(len(words)) if j != i), default=0)
               for i in range(len(words))]
    inside = {p for i, n in enumerate(longest) if n >= window for p in range(i, i + window)}
    spans = {p for i, n in enumerate(longest) if n >= shortest for p in range(i, i + n)}
    return len(inside), len(spans), max(longest, default=0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=20), min_size=1, max_size=4))
def test_repeats_equal_brute_force(texts):
    assert Q.repetition(texts, 2, 3) == [brute(t, 2, 3) for t in texts]


def test_one_word_many_times():
    assert Q.repetition([[b"a"] * 5000], 5, 8) == [(5000, 5000, 4999)]


def test_digest_of_given_texts(documents, texts):
    found = {r.doc_id: r for r in Q._query(documents.sparkSession, "/root/testdata/sf0.001").collect()}
    for i in random.Random(1).sample(sorted(texts), 40):
        text, words = texts[i], texts[i].split()
        lines = [x for x in text.split("\n") if x.strip()]
        windows = [tuple(words[j:j + 5]) for j in range(len(words) - 4)]
        repeated = {p for j, w in enumerate(windows) if windows.count(w) > 1 for p in range(j, j + 5)}
        failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        row = found[i]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == (
            len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            sum(x in lines[:j] for j, x in enumerate(lines)), len(repeated), failed)
        assert not (row.base_failed and row.kept)


def test_limits(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    clean = [word() for _ in range(1000)]
    half = clean[:300]
    long = [word() for _ in range(3000)]
    cases = {"clean": clean, "covered": half[:180] + half[:120], "longest": long + long[:260], "short": clean[:9]}
    df = spark.createDataFrame([(k, " ".join(v)) for k, v in cases.items()], "doc_id string, text string")
    kept = {r.doc_id for r in Q.quality_filter(df).collect()}
    assert kept == {"clean"}
    # the window rule alone would keep the long repeat in a long text
    measured = {r.doc_id: r.quality for r in Q.quality_measures(df).collect()}
    assert not measured["longest"].base_failed and measured["longest"].longest_repeat == 260


def test_odd_rows(odd, empty):
    found = Q.quality_measures(odd)
    assert found.columns == odd.columns + ["quality"] and found.count() == odd.count()
    assert all(r.quality.base_failed for r in found.where("doc_id < 5 OR doc_id IS NULL").collect())
    kept = Q.quality_filter(odd.withColumnRenamed("key", "quality"))
    assert kept.columns == [*odd.columns[:-1], "quality"]
    assert Q.quality_filter(empty).count() == 0
