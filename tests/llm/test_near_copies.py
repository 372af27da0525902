import random
from contextlib import contextmanager

import pytest

from millrace.llm import near_copies as C

COLUMNS = "doc_id int, text string"


def runs_of(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_groups(texts):
    """Smallest id reachable over texts whose runs are alike to 0.8, each pair compared."""
    runs = {i: runs_of(t) for i, t in texts.items()}
    holders = {}
    for i, own in runs.items():
        for run in own or {None}:
            holders.setdefault(run, []).append(i)

    def linked(a):
        near = {b for run in runs[a] or {None} for b in holders[run]}
        return [b for b in near if 10 * len(runs[a] & runs[b]) >= 8 * len(runs[a] | runs[b])]
    least = {}
    for start in sorted(texts):
        queue = [] if start in least else [start]
        while queue:
            a = queue.pop()
            if a not in least:
                least[a] = start
                queue += linked(a)
    return least


def kept(frame):
    return sorted(r.doc_id for r in C.drop_near_duplicates(frame).collect())


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_documents_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    expected = sorted(set(near_groups({r.doc_id: r.text for r in docs.collect()}).values()))
    assert kept(docs) == expected and len(expected) < docs.count()


def words(rng, n):
    return ["".join(rng.choices("abcdefghijkl", k=rng.randint(2, 8))) for _ in range(n)]


def test_one_word_set_in_many_orders(spark):
    """Texts that agree in their words, and in any mark of them, but not in their runs; each has a true copy."""
    stock, texts = [f"word{i}" for i in range(200)], {}
    for i in range(60):
        random.Random(i).shuffle(stock)
        texts[10 * i] = " ".join(stock)
        texts[10 * i + 1] = " ".join([*stock[:100], "changed", *stock[101:]])
    assert kept(spark.createDataFrame(list(texts.items()), COLUMNS)) == [10 * i for i in range(60)]


def test_dense_groups_chains_and_common_passages(spark, monkeypatch):
    monkeypatch.setattr(C, "COUNTED", 2)
    rng = random.Random(3)
    line, texts = " ".join(words(rng, 12)), {}
    # copies of one text, each changed in its own places: some are alike only through others
    base = words(rng, 150)
    for i in range(120):
        own = list(base)
        for at in rng.sample(range(150), rng.choice([0, 1, 2, 3, 4])):
            own[at] = f"new{i}"
        texts[i] = " ".join(own)
    # a chain: each text is like the one before, the ends are not alike
    chain = words(rng, 400)
    for i in range(12):
        texts[1000 + i] = " ".join(chain[12 * i:12 * i + 200])
    # different texts with one line in common, and copies of some of them
    for i in range(80):
        own = words(rng, 40)
        texts[2000 + 2 * i] = " ".join([*own, line])
        if i % 8 == 0:
            texts[2001 + 2 * i] = " ".join([*own, line, "end"])
    expected = sorted(set(near_groups(texts).values()))
    assert 90 < len(expected) < 140
    assert kept(spark.createDataFrame(list(texts.items()), COLUMNS)) == expected


def test_the_order_of_runs_changes_nothing(spark, documents, monkeypatch):
    found = []
    for counted, often in ((1, 2), (10 ** 9, 3)):
        monkeypatch.setattr(C, "COUNTED", counted)
        monkeypatch.setattr(C, "OFTEN", often)
        found.append(kept(documents))
    assert found[0] == found[1]


def test_short_texts_and_the_bound(spark):
    texts = {1: "one two", 2: "ONE two", 3: "one two three", 4: "a b c d e", 5: "a b c d e f",
             6: " ".join(f"w{i}" for i in range(13)), 7: " ".join(f"w{i}" for i in range(12)), 8: None, 9: " \t\n", 10: ""}
    # nine runs against eight of them: 8/9 is enough; one run against two is not
    assert kept(spark.createDataFrame(list(texts.items()), COLUMNS)) == [1, 3, 4, 5, 6, 8]


def test_odd_rows(odd, empty):
    found = C.drop_near_duplicates(odd)
    assert sorted(r.doc_id for r in found.collect()) == [1, 4, 5, 6] and found.columns == odd.columns
    assert C.drop_near_duplicates(empty).count() == 0 and C.drop_near_duplicates(empty).columns == empty.columns


def test_marks_give_candidates_and_texts_decide(spark, odd, empty, monkeypatch):
    """The pipeline's candidates are SimHash links; different texts of one mark stay apart, edited copies are found."""
    import corpus_pipeline
    asked = []
    links = C.fingerprint_links
    monkeypatch.setattr(C, "fingerprint_links", lambda marks: asked.append(marks) or links(marks))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    least = near_groups({r.doc_id: r.text for r in docs.collect()})
    found = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert len(asked) == 1
    # nothing else goes, and few near copies are beyond the marks
    kept_by_rule, dropped = set(least.values()), {i for i, first in least.items() if first != i}
    assert kept_by_rule <= found and len(dropped & found) <= 0.1 * len(dropped)
    # the mark of a text that repeats one run is that of the run, whatever else it says
    rng = random.Random(5)
    alike = spark.createDataFrame([(i, " ".join(["again"] * 200 + words(rng, 60))) for i in range(6)], COLUMNS)
    assert corpus_pipeline.near_dedup(spark, alike, "").count() == 6


def test_rows_of_a_dense_group_grow_with_its_size(spark, monkeypatch):
    """Copies of one text that marks link and the rule mostly does not: neither lists nor pairs grow with the square."""
    made, staging = {}, C.staging

    @contextmanager
    def counted(session):
        with staging(session) as put:
            def kept_count(df, label):
                staged = put(df, label)
                made[label] = max(made.get(label, 0), staged.count())
                return staged
            yield kept_count
    monkeypatch.setattr(C, "staging", counted)
    rng = random.Random(7)
    base = words(rng, 200)
    texts = {}
    for i in range(400):
        own = list(base)
        for at in rng.sample(range(200), rng.randint(4, 12)):
            own[at] = f"new{i}x{at}"
        texts[i] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), COLUMNS)
    found = {r.doc_id for r in C.drop_near_duplicates(docs, by="marks").collect()}
    # every link between texts that have a fingerprint near another's is found
    assert found == set(near_groups(texts).values())
    assert made["candidates"] > 390
    assert made["lists"] <= 20 * len(texts) and made["pairs"] <= 10 * len(texts)
