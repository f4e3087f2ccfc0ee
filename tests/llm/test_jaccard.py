from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from txloom.llm import jaccard
from txloom.llm.components import components
from txloom.llm.queries import op4_jaccard_join
from txloom.llm.shared import WordHashes

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def plain(pairs):
    """Every pair compared; doc_id: (size, smallest id reachable)."""
    sets = [(i, shingles(t)) for i, t in pairs]
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:k]):
            both = len(a & b)
            if both and 100 * both >= 80 * (len(a) + len(b) - both):
                parent[root(k)] = root(j)
    least = defaultdict(lambda: 10**18)
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min(least[root(k)], i)
    return sorted((i, len(s), least[root(k)]) for k, (i, s) in enumerate(sets))


def found(docs):
    rows = jaccard.jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(tuple(r) for r in rows)


def near_copies(seed, groups, size, words):
    """Groups of edited copies, many of them close to the threshold, in chains and around a base."""
    rng = random.Random(seed)
    pairs = []
    for _ in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice(words))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(max(2, len(copy) // 12))):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                base = copy
            pairs.append((len(pairs) * 7 % 9973, " ".join(copy)))
    return pairs


def test_near_the_threshold(spark, docs_of):
    pairs = near_copies(1, 8, 25, (6, 9, 14, 30, 36, 60, 110, 330))
    assert found(docs_of(*pairs)) == plain(pairs)


def test_one_large_group_in_small_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 7)
    pairs = near_copies(2, 1, 90, (70,)) + [(10_000 + k, f"common line that all of these share a{k} b{k} c{k} d{k}") for k in range(40)]
    assert found(docs_of(*pairs)) == plain(pairs)


def test_blocks_are_cut_by_shingles_too(spark, docs_of, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 400)
    pairs = near_copies(3, 1, 60, (70,))
    assert found(docs_of(*pairs)) == plain(pairs)


def test_odd_rows(spark, docs_of):
    pairs = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one TWO"), (6, "one two three"), (7, "É a b c d e"), (8, "é a b c d e"), (9, "z " * 40_000), (10, "z " * 50_000)]
    assert found(docs_of(*pairs)) == plain(pairs)
    rows = jaccard.jaccard_components(docs_of((None, "a b c d e f"), (7, "a b c d e f"), (None, "q"), (8, "r s"), (8, "r s"), (None, ""))).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in rows) == [(0, 0, 0), (0, 1, 0), (0, 2, 7), (7, 2, 7), (8, 1, 8), (8, 1, 8)]


def test_empty_table(spark, docs_of):
    assert found(docs_of((1, "x")).limit(0)) == []


@pytest.mark.parametrize("seed", range(4))
def test_linked_sets_share_a_key(seed):
    rng = np.random.default_rng(seed)
    for n in [*range(4, 60), 107, 108, 120, 323, 324, 400, 3000]:
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for _ in range(4):
            gone = rng.integers(0, len(a) // 9 + 1)
            b = np.unique(np.append(a[gone:], rng.integers(0, 2**63, rng.integers(0, len(a) // 9 + 1)).astype(np.uint64)))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert len(np.intersect1d(jaccard.segment_keys(a), jaccard.segment_keys(b))), n


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(0)
    for n, m in ((10, 12), (100, 90), (1000, 1200)):
        a, b = (np.unique(rng.integers(0, 50 * n, k).astype(np.uint64)) for k in (n, m))
        x, y = (np.frombuffer(jaccard.sketch(s), np.uint8)[None, :] for s in (a, b))
        size = min(x.shape[1], y.shape[1])
        assert np.bitwise_count(jaccard.folded(x, size) ^ jaccard.folded(y, size)).sum() <= len(np.setxor1d(a, b))


def test_components(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert sorted(map(tuple, got)) == [(k, 0) for k in range(31)] + [(100, 100), (101, 100)]


def test_query(spark):
    pairs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, op4_jaccard_join(spark, SF).collect())) == plain(pairs)


def test_words_are_those_of_bytes():
    assert len(jaccard.shingles("a\x1cb c\x85d e", WordHashes())) == 1


def test_a_group_sends_out_fewer_links_than_rows(spark, docs_of, monkeypatch):
    """Eighty copies that all link with each other, looked at pair by pair from the start."""
    base = [f"w{k}" for k in range(120)]
    pairs = [(k, " ".join([*base, f"end{k}"])) for k in range(80)]
    made = []
    rest = jaccard._rest
    monkeypatch.setattr(jaccard, "_to_centres", lambda live, rank: spark.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(jaccard, "_rest", lambda live, *more: made.append((live.count(), live.select("key").distinct().count(), links := rest(live, *more), links.count())) or links)
    assert found(docs_of(*pairs)) == plain(pairs)
    rows, keys, _, links = made[0]
    assert 79 <= links <= rows - keys and links < 80 * 79 // 4


def test_keys_with_the_same_documents_are_one(spark):
    keys = [(1, [10, 11, 12, 13]), (2, [10, 11, 12, 14]), (1, [10, 11]), (3, [12, 15])]
    described = spark.createDataFrame(keys, "node long, keys array<long>")
    assert sorted(map(tuple, jaccard._live(described).collect())) == [(10, 1), (10, 2), (12, 1), (12, 2), (12, 3)]
