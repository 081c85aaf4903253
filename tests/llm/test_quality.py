import random
import re
from collections import Counter

import corpus_pipeline
from flowmetrics.llm import quality
from tests.llm.brute import WORD


def _signals(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def _prose(rng, n):
    stops = quality.STOP_WORDS[:8]
    w = [rng.choice(stops) if rng.random() < 0.3 else
         "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(n)]
    return re.sub(r"((?:\S+ ){11}\S+) ", r"\1.\n", " ".join(w))


def _rows():
    rng = random.Random(6)
    good = [(i, _prose(rng, rng.randrange(60, 200))) for i in range(60)]
    bad = [(100 + i, " ".join(w + rng.choice(["###", "&&&"]) for w in _prose(rng, 90).split()))
           for i in range(6)]
    bad += [(200 + i, _prose(rng, 90).upper()) for i in range(6)]
    bad += [(300 + i, _prose(rng, 4).replace("\n", " ") * 40) for i in range(6)]
    edges = [(400, None), (401, ""), (402, " \n\t "), (403, "a b a b a b a"), (404, "x\n x\nx\n\n\n"),
             (405, "\x0b a\x0c\x85b c \r\n"), (404, "x\n x\nx\n\n\n"), (None, "é ü <|>"), (406, "tok " * 20000)]
    return good, bad, edges


def test_signals_equal_brute_force(session, documents):
    good, bad, edges = _rows()
    rows = good + bad + edges
    got = quality.document_signals(documents(rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
    ).collect()
    want = [(d, *_signals(t)) for d, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_bad_documents_go_and_good_ones_stay(session, documents):
    good, bad, _ = _rows()
    judged = {r["doc_id"]: r for r in quality.judged_documents(documents(good + bad)).collect()}
    assert all(judged[d]["kept"] for d, _ in good)
    assert not any(judged[d]["kept"] for d, _ in bad)
    # The vote alone, without the plain rule, tells them apart.
    assert max(judged[d]["p_good"] for d, _ in bad) < 0.5


def test_good_short_documents_survive_the_first_stage(session, documents):
    good, bad, _ = _rows()
    rng = random.Random(7)
    short = [(500 + i, _prose(rng, rng.randrange(25, 45))) for i in range(20)]
    docs = documents(good + bad + short)
    judged = {r["doc_id"]: r for r in quality.judged_documents(docs).collect()}
    assert all(r["kept"] == (r["p_good"] >= 0.5) for r in judged.values())
    left = {r["doc_id"] for r in corpus_pipeline.quality_rules(session, docs, "").collect()}
    assert left == {d for d, _ in good + short}


def test_fit_recovers_accuracies():
    rng = random.Random(8)
    truth = [(0.7, 0.02), (0.6, 0.05), (0.8, 0.01), (0.5, 0.03)]
    patterns = Counter()
    for _ in range(40_000):
        bad = rng.random() < 0.2
        votes = tuple(0 if rng.random() < 0.3 else -1 if rng.random() < (a if bad else b) else 1
                      for a, b in truth)
        patterns[votes] += 1
    model = quality.fit_votes(patterns, 4)
    assert abs(model.bad_share - 0.2) < 0.03
    for (a, b), (x, y) in zip(truth, model.bad_votes):
        assert abs(a - x) < 0.08 and abs(b - y) < 0.03


def test_columns_pass_through_and_empty_table(session, documents):
    rows = documents([(1, "a b c")]).withColumnRenamed("lang", "n_words")
    out = quality.judged_documents(rows)
    assert {"doc_id", "text", "source", "n_chars", "kept", "p_good"} <= set(out.columns)
    assert out.columns.count("n_words") == 1 and out.first()["n_words"] == 3
    assert quality.judged_documents(documents([])).collect() == []


def test_first_stage_returns_columns_named_like_signals(session, documents):
    good, bad, _ = _rows()
    docs = documents(good + bad).selectExpr("*", "lang AS votes", "doc_id AS n_words", "source AS kept", "1.5D AS p_good")
    out = corpus_pipeline.quality_rules(session, docs, "")
    assert out.dtypes == docs.dtypes
    want = docs.where("doc_id < 100").collect()
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want))
