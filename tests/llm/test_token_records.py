import os
import random
import struct
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import token_records as R
from millrace.llm.crc32c import crc32c, crc32c_all, masked

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_checksums():
    assert crc32c(b"123456789") == 0xE3069283 and crc32c(b"") == 0
    # the masked form of an eight-byte length, as record files carry it
    assert crc32c_all([b"\0" * 32]).tolist() == [0x8A9136AA]
    data = [os.urandom(n) for n in (0, 1, 3, 4, 255, 256, 257, 1000, 5000)]
    assert crc32c_all(data).tolist() == [crc32c(d) for d in data]
    value = crc32c(b"123456789")
    assert int(masked(np.array([value]))[0]) == (((value >> 15) | (value << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def test_damage_is_noticed():
    framed = R.frames([b"abcd", b"ef"])
    assert R.unframed(framed) == [b"abcd", b"ef"]
    for position in (0, 9, 12, len(framed[0]) - 1):
        broken = bytearray(framed[0])
        broken[position] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            R.unframed([bytes(broken)])


TRICKY = ["It's <|endoftext|> x", "a<|startoftext|>b", "É é é", "x ́y", "a b", "tab\tand\nline", "漢字", "1234 5",
          "ΑΣ ΣΑΣ", "\x1c a \x85 b", "", "   ", "İstanbul", "🙂 ok"]


def digests(df):
    index, root = R.write_records(df, PATH, 2)
    return index, root, {r.doc_id: r for r in R.record_digests(index, root, "doc_id").collect()}


def test_ids_equal_the_library(spark, documents, texts):
    library = Tokenizer.from_file(PATH)
    all_texts = {**texts, **{100_000 + i: t for i, t in enumerate(TRICKY)}}
    df = documents.select("doc_id", "text").union(spark.createDataFrame(
        [(i, t) for i, t in all_texts.items() if i >= 100_000], "doc_id long, text string")).repartition(5)
    index, root, found = digests(df)
    start = 0
    for i in sorted(all_texts):
        ids = [*library.encode(all_texts[i], add_special_tokens=False).ids, 2]
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (
            start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), repr(all_texts[i][:50])
        start += len(ids)
    # any selection in any order
    chosen = random.Random(1).sample(sorted(all_texts), 20)
    some = R.read_records(index.where(F.col("key").isin(chosen)).orderBy(F.rand(1)), root)
    assert {r.key: r.ids for r in some.collect()} == {
        i: [*library.encode(all_texts[i], add_special_tokens=False).ids, 2] for i in chosen}


def test_files_are_plain_record_files(spark, tmp_path):
    df = spark.createDataFrame([(i, f"word {i}") for i in range(30)], "doc_id long, text string")
    index, root = R.write_records(df, PATH, 2, root=str(tmp_path / "records"), shards=3)
    files = sorted(Path(root.removeprefix("file://")).iterdir())
    assert [f.name for f in files] == [R.shard_name(i) for i in range(len(files))] and len(files) > 1
    total = 0
    for f in files:
        data, at = f.read_bytes(), 0
        while at < len(data):
            (length,) = struct.unpack_from("<Q", data, at)
            assert struct.unpack_from("<I", data, at + 8)[0] == int(masked(crc32c_all([data[at:at + 8]]))[0])
            at += 16 + length
            total += 1
        assert at == len(data)
    assert total == 30 and index.count() == 30
    keys = [r.key for r in index.orderBy("shard", "position").collect()]
    assert keys == sorted(keys)


def test_tokenizers_that_keep_white_space_are_refused():
    with pytest.raises(ValueError):
        R.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"), 0)


def test_odd_rows(odd, empty):
    index, root = R.write_records(odd, PATH, 2)
    found = R.record_digests(index, root, "doc_id").orderBy("start").collect()
    assert len(found) == odd.count() and found[0].start == 0
    keys = [r.doc_id for r in found]
    assert keys[:2] == [None, None] and keys[2:] == sorted(keys[2:])
    assert [b.start for b in found[1:]] == [a.start + a.n_tokens for a in found[:-1]]
    assert {r.n_tokens for r in found if r.doc_id in (1, 2, 3)} == {1}
    index, root = R.write_records(empty, PATH, 2)
    assert R.record_digests(index, root, "doc_id").count() == 0


def test_strings_equal_the_library():
    library, encoder, rng = Tokenizer.from_file(PATH), R.WordEncoder(PATH, 2), random.Random(6)
    assert encoder.cuts_here
    marks = ["'s", "'LL", "'", "''t", "don't", "x'Re", "12", "3.5", "...", "ß", "É", "e\u0301", "ÿ", "×", "œ", "\xa0", "\x1c", "漢", "\u200b",
             "<|endoftext|>", "İ", "ª", "²", "--", "a", "Z", " ", " ", "\n", "\t", "\x0b", "_", "\x7f", "\x00"]
    texts = ["".join(rng.choices(marks, k=rng.randint(1, 12))) for _ in range(6_000)]
    texts += [f"{chr(a)}{chr(b)} {chr(b)}" for a in range(0x20, 0x180, 3) for b in range(0x20, 0x180, 7)]
    kept = encoder.encode([t.encode() for t in texts])
    for text, ids in zip(texts, kept):
        assert np.frombuffer(ids, encoder.kind).tolist() == [*library.encode(text, add_special_tokens=False).ids, 2], repr(text)


def test_a_full_store_changes_nothing(monkeypatch):
    encoder = R.WordEncoder(PATH, 2)
    first = encoder.encode([b"some words", b"and some more"])
    monkeypatch.setattr(R, "KEPT", 1)
    assert [encoder.encode([b"some words", b"and some more"]) for _ in range(3)] == [first] * 3


def test_the_index_knows_the_width(spark, tmp_path):
    # a vocabulary beyond two bytes: the same model with unused words added
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.add_tokens([f"unused{i}unused" for i in range(20_000)])
    wide = str(tmp_path / "wide.json")
    tokenizer.save(wide)
    texts = {1: "some words", 2: "unused19999unused it is", 3: ""}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    index, root = R.write_records(df, wide, 2)
    assert {r.width for r in index.collect()} == {4}
    expected = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in texts.items()}
    assert max(expected[2]) > 65_535
    assert {r.key: r.ids for r in R.read_records(index, root).collect()} == expected
    found = {r.doc_id: r.ids_crc32 for r in R.record_digests(index, root, "doc_id").collect()}
    assert found == {i: zlib.crc32(np.array(ids, "<u4").tobytes()) for i, ids in expected.items()}
