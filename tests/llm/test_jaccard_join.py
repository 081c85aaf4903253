import random

import numpy as np
import pyarrow as pa
import pytest

from flowmetrics.llm import jaccard_join
from flowmetrics.llm.components import connected_components
from tests.llm.brute import components


def _corpus(seed, groups, copies, length):
    """Groups of edited copies: some link, some only through others, some not."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(length)] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(text)))
    return rows


EDGES = [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "one two"),
         (906, "One  Two"), (907, "one two"), (None, "a b c d e f"), (950, "a b c d e f"),
         (907, "one two"), (None, "lone words nobody else has"), (908, "x " * 3000)]


@pytest.mark.parametrize("cluster_blocks", [16, 0])
def test_components_equal_brute_force(session, documents, monkeypatch, cluster_blocks):
    monkeypatch.setattr(jaccard_join, "CLUSTER_BLOCKS", cluster_blocks)
    monkeypatch.setattr(jaccard_join, "SMALL_GROUP", 6)
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", 500)
    rows = _corpus(1, 8, 5, 60) + [(i + 100, t) for i, t in _corpus(2, 1, 40, 80)] + EDGES
    got = jaccard_join.jaccard_components(documents(rows)).collect()
    want = components(rows, 90, 100, 3)
    key = str
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_other_threshold_and_width(session, documents):
    rows = _corpus(3, 6, 6, 50) + EDGES
    got = jaccard_join.jaccard_components(documents(rows), 80, 100, 5).collect()
    assert sorted(map(tuple, got), key=str) == sorted(components(rows, 80, 100, 5), key=str)


def test_one_stays_of_each_component(session, documents):
    rows = _corpus(4, 5, 4, 50) + EDGES
    kept = jaccard_join.one_per_component(documents(rows)).collect()
    texts = [(r["doc_id"], r["text"]) for r in kept]
    want = components(rows, 90, 100, 3)
    expected = {(d, t) for (d, t), (_, n, c) in zip(rows, want) if n and d == c}
    assert (None, "lone words nobody else has") in texts
    expected.discard((None, "lone words nobody else has"))
    assert {x for x in texts if x[1] and x[1].strip() and x[0] is not None} == expected
    # Without words: all stay; rows equal in id and text: one stays.
    assert sum(1 for _, t in texts if not (t or "").strip()) == 3
    assert len(texts) == len(set(texts))
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


def test_empty_table(session, documents):
    assert jaccard_join.jaccard_components(documents([]), 90, 100, 3).collect() == []


def test_prefix_keeps_every_linked_pair():
    least = jaccard_join.Threshold(90, 100)
    rng = np.random.default_rng(5)
    for n in (1, 2, 9, 10, 11, 57, 300):
        a = np.unique(rng.integers(0, 1 << 62, n, np.uint64))
        for cut in range(0, 1 + len(a) // 20):
            b = np.unique(np.concatenate((a[cut:], rng.integers(0, 1 << 62, cut, np.uint64))))
            if least.linked(a, b):
                assert jaccard_join._candidate(a, b, least)


def test_short_texts_differ_from_windows():
    sets = jaccard_join.shingle_sets(pa.array(["a b", "a b c", None, "A b", ""]), 3)
    assert [len(s) for s in sets] == [1, 1, 0, 1, 0]
    assert sets[0][0] == sets[3][0] != sets[1][0]


def test_components_of_chains_and_stars(session):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)] + [(300, 7), (5, 5), (None, 3), (7, 200)]
    edges = session.createDataFrame(chain + star, "u bigint, v bigint").repartition(4)
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, 300, *range(200, 260)]}


def test_components_without_edges(session):
    assert connected_components(session.createDataFrame([], "u string, v string")).collect() == []


def test_parity_bits_differ_in_no_more_places_than_sets():
    rng = np.random.default_rng(3)
    for n, m, common in [(50, 60, 40), (1000, 900, 880), (3, 2, 0), (5000, 64, 64), (1, 1, 1), (700, 700, 0)]:
        every = np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64))
        rng.shuffle(every)
        a, b = every[:n], every[n - common : n - common + m]
        differ = n + m - 2 * len(np.intersect1d(a, b))
        near = jaccard_join.unlike_bits(jaccard_join.scaled_parity(a), jaccard_join.scaled_parity(b))
        bits = jaccard_join.parity(a) ^ jaccard_join.parity(b)
        assert near <= differ and sum(int(x).bit_count() for x in bits.view(np.uint64)) <= differ
        if not common and n > 100:
            assert near > 0.8 * min(n, m) / 2


@pytest.mark.parametrize("within", [True, False])
def test_alike_forest_connects_all_that_link(within):
    least = jaccard_join.Threshold(90, 100)
    rng = np.random.default_rng(8)
    sets = []
    for n in [1, 2, 9, 30, 60, 63, 64, 66, 127, 129, 500, 1020, 1030, 2000] * 3:
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for cut in (0, n // 25, n // 12):
            sets.append(np.unique(np.append(base[cut:], rng.integers(0, 1 << 63, cut // 2, dtype=np.uint64))))
    rng.shuffle(order := np.arange(len(sets)))
    sets = [sets[i] for i in order]
    sides = rng.integers(0, 2, len(sets))
    bits = [jaccard_join.scaled_parity(s).tobytes() for s in sets]
    edges = jaccard_join.alike_forest(np.array([len(s) for s in sets]), sides, bits, within, least)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in edges:
        assert (within or sides[i] != sides[j]) and find(i) != find(j)  # a forest
        root[find(i)] = find(j)
    linked = [(i, j) for i in range(len(sets)) for j in range(i)
              if (within or sides[i] != sides[j]) and least.linked(sets[i], sets[j])]
    assert len(linked) > 30 and all(find(i) == find(j) for i, j in linked)
    assert len({find(i) for i in range(len(sets))}) > 14  # sets unlike each other stay apart


@pytest.mark.parametrize("block", [2048, 2])
def test_sets_without_an_alike_partner_are_not_read_again(session, documents, monkeypatch, block):
    """Texts that share a passage are in large groups; only two of them are alike."""
    monkeypatch.setattr(jaccard_join, "ALIKE_BLOCK", block)
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, passage + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))) for i in range(9)]
    rows.append((9, rows[4][1].rsplit(" ", 1)[0] + " other"))
    wanted, read = [], jaccard_join.node_sets

    def counted(docs, nodes, width):
        wanted.append(nodes.count())
        return read(docs, nodes, width)

    monkeypatch.setattr(jaccard_join, "node_sets", counted)
    monkeypatch.setattr(jaccard_join, "SMALL_GROUP", 3)
    got = jaccard_join.jaccard_components(documents(rows)).collect()
    assert sorted(map(tuple, got)) == sorted(components(rows, 90, 100, 3))
    assert wanted == [2]
