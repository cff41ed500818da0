"""SimHash groups against all pairs of fingerprints."""

import random

import pytest
import xxhash

from innledger.llm import simhash
from innledger.llm.queries import QUERIES
from innledger.llm.components import connected_components

SCHEMA = "doc_id long, text string, fp string, tie int, component string"


def plain_fingerprint(text, shingle=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in text.translate({i: " " for i in range(9, 14)}).split(" ") if w]
    parts = [words[i : i + shingle] for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, distance=2):
    """Smallest id reachable for each id, from all pairs."""
    found = {i: i for i in fps}

    def top(i):
        while found[i] != i:
            i = found[i]
        return i

    by_fp = {}
    for i, fp in sorted(fps.items()):
        by_fp.setdefault(fp, []).append(i)
    distinct = list(by_fp)
    links = [(by_fp[a][0], i) for a in distinct for i in by_fp[a][1:]]
    for k, a in enumerate(distinct):
        links += [(by_fp[a][0], by_fp[b][0]) for b in distinct[:k] if (a ^ b).bit_count() <= distance]
    for a, b in links:
        a, b = sorted((top(a), top(b)))
        found[b] = a
    return {i: top(i) for i in fps}


def test_whole_table(spark):
    got = QUERIES["op3_simhash_near_dedup"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == fps
    assert {r.doc_id: r.component_id for r in got} == groups(fps)
    assert all(len(r.fingerprint) == 16 and r.fingerprint.islower() | r.fingerprint.isdigit() for r in got)


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
def test_links_are_all_pairs(spark, distance):
    rng = random.Random(distance)
    fps = [rng.getrandbits(64) for _ in range(40)] + [0, 2**64 - 1, 2**63, 1]
    for fp in list(fps):
        for _ in range(6):
            for bit in rng.sample(range(64), rng.randint(1, distance + 1)):
                fp ^= 1 << bit
            fps.append(fp)
    signed = {f - 2**64 if f >= 2**63 else f for f in fps}
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = [(min(r.a, r.b), max(r.a, r.b)) for r in simhash.linked_fingerprints(df, distance).collect()]
    want = [
        (a, b) for a in signed for b in signed
        if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance
    ]
    assert sorted(got) == sorted(want)


def test_odd_rows(spark):
    text = "one two three four five six"
    rows = [
        (None, text, "a", 1, None), (4, text.upper(), "a", 1, None), (4, text, "b", 1, None),
        (4, text, "b", 1, None), (9, None, "c", 1, None), (8, "", "c", 1, None),
        (7, "\t \n", "c", 1, None), (6, "word", None, None, None), (None, "other words", "d", 1, None),
        (5, text * 20000, None, None, None),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} >= {
        (None, 4), (4, 4), (9, 7), (8, 7), (7, 7), (6, 6), (None, None),
    }
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 4, 5, 6, 7]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.one_of_each(docs).collect() == []


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, 501 + i) for i in range(50)]
    edges += [(900, 901), (901, 902), (902, 900), (7, 7), (-5, 130), (901, 900)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {n: -5 for n in [*range(100, 141), -5]} | {500 + i: 500 for i in range(51)}
    want |= {900: 900, 901: 900, 902: 900}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
