import itertools
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import token_counts as T

PATH = public_tokenizers.path("byte_bpe_50k.json")

TRICKY = ["a  b", "a   b", "a \n b", "a\n\n  b", "trailing  ", "trailing ", " lead", "  lead", "it's don't 's", "x1y22 333",
          "<|endoftext|>", "a <|endoftext|> b", "a  <|endoftext|>b", "tab\tnew\r\nline", "é à ñ  ü", "漢字 かな", "a\u00a0 b",
          "a\u00a0\u00a0b", "\u2003 \u2003x", "🙂🙂 x", "a\x1cb \x1d c", "...!!! ??", "a\u0301 b", "\x0b \x0c", "", " ", "   "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_counts_equal_the_library(spark, library):
    df = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id int, text string")
    found = {r.doc_id: r.n_tokens for r in T.count_tokens(df, PATH).collect()}
    for i, text in enumerate(TRICKY):
        assert found[i] == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_counts_of_given_texts(spark, library, documents, texts):
    found = {r.doc_id: r for r in T.count_tokens(documents, PATH).collect()}
    for i, text in texts.items():
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (found[i].n_tokens, found[i].n_bytes, found[i].over_limit) == (n, len(text.encode()), n > 1024)


def test_whole_tokens_are_one_token(library):
    proved = T.whole_tokens(PATH)
    assert 45_000 < len(proved) <= 50_257 and " the" in proved and "<|endoftext|>" not in proved


def test_a_full_store_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(T, "KEPT", 1)
    counter = T.Counter(PATH, T.whole_tokens(PATH))
    for _ in range(3):
        assert counter.count(["some words here", "and others"]) == [
            len(library.encode(t).ids) for t in ("some words here", "and others")]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        T.Counter(public_tokenizers.path("word_bpe_49k.json"), frozenset())


def test_odd_rows(odd, empty):
    found = T.count_tokens(odd, PATH)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and found.count() == odd.count()
    by_id = {r.doc_id: (r.n_bytes, r.n_tokens) for r in found.collect()}
    assert by_id[1] == by_id[2] == (0, 0) and by_id[5][0] == 150_000
    assert T.count_tokens(empty, PATH).count() == 0


def test_all_runs_of_white_space(library):
    blanks = " \n\t\r\x0b\x85\xa0\u2003\u2009\u200b\u3000"
    counter = T.Counter(PATH, T.whole_tokens(PATH))
    runs = ["".join(r) for n in (2, 3, 4) for r in itertools.product(blanks, repeat=n)]
    rng = random.Random(5)
    runs += ["".join(rng.choices(blanks, k=rng.randint(5, 9))) for _ in range(5_000)] + [" \xa0 \xa0 ", ": \xa0 \xa0\n"]
    for text in (lambda r: f"a{r}b", lambda r: f"word{r}", lambda r: f"{r}word"):
        texts = [text(r) for r in runs]
        expected = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [t for t, n, m in zip(texts, counter.count(texts), expected) if n != m] == []
