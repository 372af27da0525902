import collections
from pathlib import Path

import pytest

import corpus_pipeline
from millrace.llm import decontaminate, quality_rules
from millrace.llm.catalog import queries
from millrace.workspace import shared_folder
from test_line_chunks import brute_passages
from test_near_copies import near_groups

FOLDER = "/root/testdata/sf0.001"


def test_the_pipeline_equals_its_stages_by_hand(spark, texts):
    left = {}
    for i, text in texts.items():
        words = text.encode().split()
        repeated, covered, longest = quality_rules.repetition([words], 5, 8)[0]
        if len(words) >= 10 and 100 * repeated <= 20 * len(words) and 100 * covered <= 30 * len(words) and longest <= 250:
            left[i] = text
    assert 0 < len(left) < len(texts)
    left = brute_passages(left)
    least = near_groups(left)
    left = {i: t for i, t in left.items() if least[i] == i}
    items = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaked = set()
    for i, text in left.items():
        words = decontaminate.words_of(text)
        for item in items:
            if any(words[j:j + len(item)] == item for j in range(len(words) - len(item) + 1)):
                leaked.add(i)
    found = corpus_pipeline.run(spark, FOLDER).collect()
    parts = collections.defaultdict(dict)
    for r in found:
        parts[r.doc_id][r.piece] = r.text
    whole = {i: "".join(p[n] for n in sorted(p)) for i, p in parts.items()}
    # windows near an item may go too, exact copies have to
    assert not leaked & whole.keys() and leaked
    assert len(left.keys() - leaked - whole.keys()) <= 1
    assert all(left[i] == t for i, t in whole.items())
    room = collections.Counter()
    for r in found:
        room[r.bin_id] += r.n_tokens
    assert max(room.values()) <= 2048


def test_stages_keep_the_columns(spark, documents):
    wide = documents.limit(30).withColumnRenamed("lang", "quality")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert sorted(stage(spark, wide, FOLDER).columns) == sorted(wide.columns)


def test_stages_take_odd_rows(spark, odd, empty):
    """What each stage makes of null and empty texts, a null key, repeated rows and a long text by itself."""
    expected = {"quality_rules": [], "line_dedup": [0, 0, 1, 2, 3, 4, 4, 5, 6], "near_dedup": [1, 4, 5, 6],
                "decontaminate": [0, 0, 1, 2, 3, 4, 4, 5, 6]}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, odd, FOLDER)
        assert stage(spark, empty, FOLDER).count() == 0, name
        if name in expected:
            assert sorted(r.doc_id or 0 for r in found.collect()) == expected[name], name
            assert sorted(found.columns) == sorted(odd.columns), name
        else:
            texts = collections.defaultdict(list)
            for r in found.collect():
                texts[r.doc_id].append((r.piece, r.text))
            assert "".join(t for _, t in sorted(texts[5])).split() == ["word"] * 30_000
            assert sorted(t for _, t in texts[4]) == ["one two three"] * 2


def test_a_run_leaves_only_its_result(spark):
    folder = shared_folder(spark)
    inside = lambda: {p.name for p in Path(folder).glob("*/*")}
    before = inside()
    corpus_pipeline.run(spark, FOLDER)
    left = {n.rsplit("-", 1)[0] for n in inside() - before}
    assert left == {"best_fit_packing"}


@pytest.mark.parametrize("number", range(1, 14))
def test_every_operator_has_a_query(number):
    assert sum(name.startswith(f"op{number}_") for name in queries()) == 1 and "pipeline" in queries()
