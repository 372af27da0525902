import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash_dedup as S
from millrace.llm.components import components


def mark(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(marks, radius=3):
    """Smallest reachable number of each item, by plain search."""
    least = {}
    for start in sorted(marks):
        if start in least:
            continue
        queue = [start]
        while queue:
            a = queue.pop()
            if a not in least:
                least[a] = start
                queue += [b for b in marks if b not in least and (marks[a] ^ marks[b]).bit_count() <= radius]
    return least


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.fixture(scope="module")
def clustered():
    rng = random.Random(3)
    values = {0, (1 << 64) - 1}
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(10):
            value = base
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                value ^= 1 << bit
            values.add(value)
    return sorted(values)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_equal_brute_force(spark, clustered, radius):
    df = spark.createDataFrame([(signed(v),) for v in clustered], "mark long")
    found = [tuple(r) for r in S.fingerprint_links(df, radius).collect()]
    assert len(found) == len(set(found)) and set(found) == {tuple(sorted((signed(a), signed(b)))) for i, a in enumerate(clustered) for b in clustered[:i]
                     if (a ^ b).bit_count() <= radius}


def test_every_value_has_a_home_within_one_bit(spark, clustered):
    homes, guests = S.with_anchors(spark.createDataFrame([(signed(v),) for v in clustered], "mark long"))
    half = F.when(F.col("side") == 0, F.col("mark").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(
        F.call_function("shiftrightunsigned", "mark", F.lit(32)))
    apart = F.bit_count(half.bitwiseXOR(F.col("anchor")))
    assert homes.agg(F.max(apart)).first()[0] <= 1 and guests.agg(F.max(apart)).first()[0] <= 2
    assert guests.groupBy("side", "mark").count().agg(F.max("count")).first()[0] <= 17


def test_larger_radius_is_refused(spark):
    with pytest.raises(ValueError):
        S.fingerprint_links(spark.createDataFrame([], "mark long"), 4)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 80)]
    links = [*chain, *star, (5000, 4999), (7, 7)]
    roots, _ = components(spark.createDataFrame(links + links[:5], "a long, b long"))
    found = {r.u: r.root for r in roots.collect()}
    assert found == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(80)}, 4999: 4999, 5000: 4999}
    none, _ = components(spark.createDataFrame([], "a long, b long"))
    assert none.count() == 0


def test_documents_equal_brute_force(documents, texts):
    found = {r.doc_id: r for r in S.near_duplicates(documents).collect()}
    marks = {i: mark(t) for i, t in texts.items()}
    expected = groups(marks)
    assert {i: (r.fingerprint, r.component_id) for i, r in found.items()} == {
        i: (f"{marks[i]:016x}", expected[i]) for i in texts}


def test_odd_rows(odd, empty):
    found = S.near_duplicates(odd)
    assert found.count() == odd.count()
    by_id = {r.doc_id: (r.fingerprint, r.component_id) for r in found.where("doc_id < 4").collect()}
    assert set(by_id.values()) == {("0" * 16, 1)}
    # the row without a key belongs to the group of its copies
    assert found.where("doc_id IS NULL AND component_id = 4").count() == 1
    assert S.near_duplicates(empty).count() == 0
