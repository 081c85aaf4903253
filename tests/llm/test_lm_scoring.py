import math
import zlib
from collections import Counter

import numpy as np

from flowmetrics.llm import lattice, lm_scoring
from tests.llm.brute import words

PIECES = ("▁", "▁a", "▁ab", "a", "b", "ab", "ba", "c", "▁c")


def _vocabulary():
    rng = np.random.default_rng(1)
    weights = rng.random(lattice.Vocabulary.FIRST + len(PIECES)) + 0.05
    return lattice.Vocabulary(PIECES, np.log(weights / weights.sum()))


def _spellings(word, vocabulary):
    """Every way to spell a word, as (pieces, probability)."""
    score = {p: s for p, s in zip(PIECES, vocabulary.scores[vocabulary.FIRST :])}

    def walk(rest):
        if not rest:
            yield (), 1.0
            return
        for k in range(1, len(rest) + 1):
            head = rest[:k]
            if head in score:
                first = ((head,), math.exp(score[head]))
            elif k == 1:
                raw = tuple(head.encode())
                first = (raw, math.exp(sum(vocabulary.scores[b] for b in raw)))
            else:
                continue
            for more, p in walk(rest[k:]):
                yield first[0] + more, first[1] * p

    return list(walk(lattice.MARK + word))


def test_recursions_equal_enumeration():
    v = _vocabulary()
    model = lattice.Lattice(v)
    tried = ["a", "ab", "abab", "bacab", "xyz", "aéb", "日a", "b" * 6, "abcabcab"]
    logs = model.log_marginals(tried)
    for word, log in zip(tried, logs):
        assert math.isclose(math.exp(log), sum(p for _, p in _spellings(word, v)), rel_tol=1e-9)
    counts = np.array([1.0, 3, 2, 5, 1, 4, 2, 1, 7])
    expected = Counter()
    for word, c in zip(tried, counts):
        found = _spellings(word, v)
        z = sum(p for _, p in found)
        for pieces, p in found:
            for piece in pieces:
                expected[piece] += c * p / z
    got = model.expected_counts(tried, counts)
    for i, piece in enumerate(PIECES):
        assert math.isclose(got[v.FIRST + i], expected[piece], rel_tol=1e-9, abs_tol=1e-12)
    for b in range(256):
        assert math.isclose(got[b], expected[b], rel_tol=1e-9, abs_tol=1e-12)


def test_long_words_do_not_underflow():
    log = lattice.Lattice(_vocabulary()).log_marginals(["ab" * 3000])[0]
    assert np.isfinite(log) and log < -1000


def _base(rows):
    train, tokens = Counter(), {}
    for d, t in rows:
        tokens.setdefault(d, []).append(words(t) + ["\n"])
        if not lm_scoring.held_out(d):
            train.update(words(t) + ["\n"])
    n, v = sum(train.values()), len(train)
    score = lambda w: math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1)))
    return n, {d: [(len(w), sum(x in train for x in w), sum(map(score, w))) for w in ws]
               for d, ws in tokens.items()}


def test_scores_of_documents(session, documents):
    rows = [(i, f"ab ba c{'ab' * (i % 4)} The THE x{i}") for i in range(60)]
    rows += [(70, None), (71, ""), (None, "ab ab"), (5, "ab again"), (72, "zz " * 4000), (5, "ab again")]
    v = _vocabulary()
    out = lm_scoring.score_documents(documents(rows), v, rounds=2).collect()
    n, want = _base(rows)
    assert len(out) == len(rows)
    for r in out:
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 10 == 0)
        assert r["train_tokens"] == n
        assert any(
            (r["n_tokens"], r["n_known"]) == x[:2] and math.isclose(r["base_score"], x[2], rel_tol=1e-9)
            for x in want[r["doc_id"]]
        )
    # The same words, the same score; more words, a lower one.
    twins = [r["score"] for r in out if r["doc_id"] == 5 and r["n_tokens"] == 3]
    assert len(twins) == 2 and twins[0] == twins[1]
    empty = {r["score"] for r in out if r["doc_id"] in (70, 71)}
    assert len(empty) == 1 and max(r["score"] for r in out) in empty


def test_fitting_raises_held_out_likelihood(session, documents):
    rows = [(i, "ab abab ba " * (1 + i % 3) + "c ab") for i in range(80)]
    score = lambda rounds: sum(
        r["score"] for r in lm_scoring.score_documents(documents(rows), _vocabulary(), rounds).collect()
        if r["held_out"]
    )
    assert score(0) < score(1) <= score(3) + 1e-9


def test_no_documents_and_no_training_documents(session, documents):
    assert lm_scoring.score_documents(documents([]), _vocabulary()).collect() == []
    held = [i for i in range(100) if lm_scoring.held_out(i)][:2]
    out = lm_scoring.score_documents(documents([(i, "ab") for i in held]), _vocabulary()).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] < 0 for r in out)
