import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from flowmetrics.llm import resampling

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, runs):
    words = PATTERN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(words[i : i + k]) for k in range(1, runs + 1) for i in range(len(words) - k + 1)], len(words)


def buckets_of(text, runs, buckets):
    return [zlib.crc32(f.encode()) % buckets for f in features(text, runs)[0]]


def brute(rows, target, percent=10, least_words=20, runs=1, buckets=10_000, seed=2024):
    s = Counter(b for _, t in rows for b in buckets_of(t, runs, buckets))
    t = Counter(b for x in target for b in buckets_of(x, runs, buckets))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out = []
    for doc_id, text in rows:
        found = [gain(b) for b in buckets_of(text, runs, buckets)]
        weight = sum(found) // len(found) if found else 0
        h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(found), weight, score, features(text, runs)[1] >= least_words))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = able[: percent * len(able) // 100]
    ranks = [(*r[:4], i) for i, r in enumerate(drawn, 1)]
    left = Counter(r[:4] for r in out) - Counter(r[:4] for r in drawn)
    return Counter([*ranks, *[(*r, None) for r in left.elements()]])


WORDS = ["alpha", "Beta", "gamma7", "é", "日本", "x" * 120, "delta-epsilon", "Z", "9"]


def make_rows(n):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randrange(0, 60)))) for i in range(n)]
    return [*rows, (None, "a " * 40), (None, "b " * 40), (None, None), (3, "again " * 30), (4, ""), (5, "\x00!?")]


@pytest.fixture
def resampled(session):
    def run(rows, target, extra=(), parts=4, **how):
        docs = session.createDataFrame([(*r, *[0] * len(extra)) for r in rows], ", ".join(["doc_id bigint", "text string", *[f"{c} int" for c in extra]]))
        wanted = session.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
        made = resampling.resample(docs.repartition(parts), wanted, **how)
        assert made.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert {t for _, t in made.dtypes} == {"bigint"}
        return Counter(tuple(r) for r in made.collect())

    return run


TARGET = ["alpha alpha gamma7", None, "日本 z"]


@pytest.mark.parametrize("how", [{}, {"few": 1}, {"percent": 100, "few": 1}, {"runs": 3, "buckets": 77}, {"percent": 55, "least_words": 0, "few": 2}])
def test_draw_equals_brute_force(resampled, how):
    rows = make_rows(300)
    assert resampled(rows, TARGET, **how) == brute(rows, TARGET, **{k: v for k, v in how.items() if k != "few"})


def test_equal_rows_are_drawn_in_the_right_number(resampled):
    rows = [(7, "same words here " * 10)] * 50 + make_rows(40)
    for percent in (1, 30, 60):
        assert resampled(rows, TARGET, percent=percent, few=1) == brute(rows, TARGET, percent=percent)


def test_few_rows_empty_tables_and_clashing_names(resampled):
    assert resampled([], TARGET) == {}
    assert resampled([(1, "a b")], []) == brute([(1, "a b")], [])
    rows = make_rows(30)
    extra = ["n_words", "buckets", "score", "rank", "at", "down", "name", "place", "item_id"]
    assert resampled(rows, TARGET, extra=extra) == brute(rows, TARGET)


def test_result_depends_on_rows_only(resampled):
    rows = make_rows(120)
    assert resampled(rows, TARGET, parts=1) == resampled(rows[::-1], TARGET, parts=9, few=3)


@pytest.mark.parametrize("runs", [1, 2, 4])
def test_buckets_of_texts(runs):
    rng = random.Random(3)
    every = ["".join(rng.choices("aB9é日 \t!\x00-", k=rng.randrange(0, 400))) for _ in range(60)]
    every += ["", None, "word" * 50_000 + " end", "  ", "a"]
    found, ends, words = resampling.feature_buckets(pa.array(every), runs, 997)
    starts = np.concatenate(([0], ends[:-1]))
    for text, a, b, n in zip(every, starts, ends, words):
        assert sorted(found[a:b].tolist()) == sorted(buckets_of(text, runs, 997))
        assert n == features(text, runs)[1]


@pytest.mark.parametrize("n,parts", [(1, 1), (2, 5), (1000, 7), (997, 1)])
def test_cut_key_is_the_nth(session, n, parts):
    rng = random.Random(n)
    keys = [(rng.randrange(5), i) for i in range(n)]
    # One partition holds most of the keys, and they lie in order.
    table = session.createDataFrame(sorted(keys), "a bigint, b bigint").repartitionByRange(parts, "a")
    for count in {1, n // 3, n // 2, n - 1, n}:
        want = sorted(keys)[count - 1] if count else None
        assert resampling.cut_key(table, ["a", "b"], count, few=1) == want
    assert resampling.cut_key(table, ["a", "b"], n + 1) is None


def test_a_pivot_has_a_quarter_on_either_side():
    rng = random.Random(1)
    for _ in range(50):
        parts = [[(rng.randrange(10**6),) for _ in range(rng.randrange(1, 200))] for _ in range(rng.randrange(1, 20))]
        halves = [resampling.Half(len(p), sorted(p)[(len(p) - 1) // 2]) for p in parts]
        pivot = resampling.weighted_median(halves)
        every = [k for p in parts for k in p]
        assert 4 * sum(k <= pivot for k in every) >= len(every)
        assert 4 * sum(k >= pivot for k in every) >= len(every)
