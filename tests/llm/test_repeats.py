import hashlib
import random

import pytest

from flowmetrics.llm import repeats
from tests.llm.brute import repeated_bytes


def _rows(seed):
    rng = random.Random(seed)
    letters = "abcdeé ß\n"
    passage = ["".join(rng.choice(letters) for _ in range(rng.randrange(60, 400))) for _ in range(4)]
    rows = []
    for i in range(40):
        own = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(0, 90)))
        text = own()
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passage)
            a = rng.randrange(0, len(p) // 2)
            text += p[a : rng.randrange(a, len(p))] + own()
        rows.append((i, text))
    rows += [(50, None), (51, ""), (52, "a" * 99), (53, "a" * 99), (54, "a" * 1000), (55, "ab" * 300)]
    rows += [(60 + i, rows[3][1] + passage[0]) for i in range(12)]
    return rows


def _want(rows, length):
    out = {}
    for doc_id, (raw, gone) in repeated_bytes(rows, length).items():
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("seed", "length"), [(1, 100), (2, 100), (3, 64)])
def test_digests_equal_brute_force(session, documents, seed, length):
    rows = _rows(seed)
    got = {r[0]: tuple(r[1:]) for r in repeats.repeat_digests(documents(rows, 5), length).collect()}
    assert got == _want(rows, length)


def test_null_ids_come_first_and_twins_go(session, documents):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdef") for _ in range(300))
    rows = [(1, text), (1, text), (None, text[:200]), (2, text[50:250])]
    got = sorted(
        ((r["doc_id"], r["n_removed"]) for r in repeats.repeat_digests(documents(rows)).collect()), key=str
    )
    # The row without an id has the first 200 bytes; of the twins one is removed whole.
    assert got == [(1, 200), (1, 300), (2, 200), (None, 0)]


def test_texts_are_cut_between_characters(session, documents):
    rng = random.Random(3)
    shared = "é" + "".join(rng.choice("xyzé") for _ in range(180)) + "é"
    rows = [(1, "a" + shared + "one"), (2, "bb" + shared + "two"), (3, None), (4, shared), (5, "  ")]
    out = {r["doc_id"]: r for r in repeats.without_repeats(documents(rows)).collect()}
    assert out[1]["text"] == "a" + shared + "one"
    assert out[2]["text"] == "bbtwo" and out[2]["n_chars"] == 5
    assert out[3]["text"] is None and out[5]["text"] == "  "
    assert 4 not in out  # nothing is left of it


def test_empty_table(session, documents):
    assert repeats.repeat_digests(documents([])).collect() == []


def test_spans_that_touch_are_one():
    assert repeats.merged([(5, 9), (0, 3), (3, 5), (12, 13)]) == [(0, 9), (12, 13)]


@pytest.mark.parametrize("longest", [1, 7, 64])
def test_long_texts_are_cut_into_buffers(session, documents, longest):
    """As with texts of hundreds of MB, only that a buffer holds a few windows here."""
    rows = _rows(4)[:25] + [(90, "é" * 400 + _rows(4)[3][1] * 3)]
    got = repeats.repeat_digests(documents(rows, 3), 100, longest).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == _want(rows, 100)
