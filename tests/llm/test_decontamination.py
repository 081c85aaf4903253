import random

import numpy as np
import pyarrow as pa

from flowmetrics.llm import decontamination as dc


def _words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


def _brute_tiles(a, b, least):
    """Greedy string tiling by looking at every pair of places again and again."""
    ma, mb, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while (i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]
                       and i + n not in ma and j + n not in mb):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return tiles
        n, i, j = best
        tiles.append((i, j, n))
        ma.update(range(i, i + n))
        mb.update(range(j, j + n))


def test_tiles_equal_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        a = np.array([rng.randrange(4) for _ in range(rng.randrange(0, 40))], np.uint64)
        b = np.array([rng.randrange(4) for _ in range(rng.randrange(0, 20))], np.uint64)
        got = dc.greedy_tiles(a, b, 3)
        assert sorted(got) == sorted(_brute_tiles(a.tolist(), b.tolist(), 3))


def test_words_are_compared_without_case_and_punctuation():
    hashes, ends = dc.plain_words(pa.array(["Été, (ONE)!", None, "été one", "..."]))
    assert ends.tolist() == [2, 2, 4, 4]
    assert hashes[:2].tolist() == hashes[2:].tolist()


def test_reordered_passages_are_caught(session, documents):
    rng = random.Random(1)
    item, other = _words(rng, 30), _words(rng, 30)
    moved = item[15:] + _words(rng, 8) + item[:15]
    rows = [
        (1, " ".join(_words(rng, 50) + item + _words(rng, 5))),
        (2, " ".join(moved).upper()),
        (3, " ".join(item[:10] + _words(rng, 40))),
        (4, " ".join(_words(rng, 80))),
        (5, None), (6, ""), (None, " ".join(item)), (1, " ".join(item)),
        (7, " ".join(item + other) + " x" * 30_000),
    ]
    bench = session.createDataFrame(
        [(9, " ".join(item)), (9, " ".join(item)), (8, " ".join(other)), (7, None), (6, "too short")],
        "item_id bigint, text string",
    )
    found = dc.contaminated(documents(rows), bench).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in found), key=str) == sorted(
        [(1, 9), (1, 9), (2, 9), (None, 9), (7, 9), (7, 8)], key=str
    )
    assert all(r["coverage"] == 1.0 for r in found)
    clean = dc.without_contaminated(documents(rows), bench).collect()
    assert sorted(r["doc_id"] for r in clean) == [3, 4, 5, 6]


def test_short_items_are_found_whole(session, documents):
    item = _words(random.Random(5), 6)
    rows = [
        (1, "so: Alpha,  BETA gamma delta!"), (2, "alpha beta delta gamma"), (3, "x alpha"), (4, "beta"),
        (5, "zeta"), (6, "..."), (7, "q zeta " + " ".join(item)), (8, "alpha beta gamma"), (9, "delta"),
    ]
    bench = session.createDataFrame(
        [(1, "zeta"), (2, "alpha beta"), (4, "alpha beta gamma delta"), (0, "?!"), (6, " ".join(item))],
        "item_id bigint, text string",
    )
    found = dc.contaminated(documents(rows, 1), bench).collect()
    got = sorted((r["doc_id"], r["item_id"], r["covered_tokens"], r["n_tiles"]) for r in found)
    assert got == [(1, 2, 2, 1), (1, 4, 4, 1), (2, 2, 2, 1), (5, 1, 1, 1), (7, 1, 1, 1), (7, 6, 6, 1), (8, 2, 2, 1)]
    clean = dc.without_contaminated(documents(rows, 1), bench).collect()
    assert sorted(r["doc_id"] for r in clean) == [3, 4, 6, 9]


def test_empty_tables(session, documents):
    none = session.createDataFrame([], "item_id bigint, text string")
    assert dc.contaminated(documents([(1, "a b c d e f")]), none).collect() == []
    assert dc.contaminated(documents([]), none).collect() == []
