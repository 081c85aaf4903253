"""Every stage of the pipeline against a plain version, each on what the stage before it kept."""

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from flowmetrics.llm import decontamination, quality, tokens
from flowmetrics.sources.scratch import scratch_path, written
from tests.llm.brute import components, repeated_bytes
from tests.llm.test_tokens import _pieces

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(session):
    """Input and output of each stage, as Spark tables."""
    docs = session.read.parquet(f"{SF}/documents.parquet")
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = written(stage(session, docs, SF), scratch_path(session, f"stage-{i}"))
        out.append((docs, made))
        docs = made
    return out


def _texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def _posterior(signals: pd.DataFrame, rounds: int) -> np.ndarray:
    """Expectation-maximisation document by document, from the rules' conditions in DuckDB."""
    tests = ", ".join(
        f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END AS v{i}" for i, r in enumerate(quality.RULES)
    )
    votes = duckdb.sql(f"SELECT {tests} FROM signals").df().to_numpy()
    bad = (4 * (votes < 0).sum(1) + 0.1) / (4 * (votes < 0).sum(1) + (votes > 0).sum(1) + 1)
    for _ in range(rounds):
        share = (bad.sum() + 0.5) / (len(bad) + 1)
        odds = np.full(len(bad), np.log(share / (1 - share)))
        for j in range(votes.shape[1]):
            said, cast = votes[:, j] < 0, votes[:, j] != 0
            of_bad = (bad[said].sum() + 0.5) / (bad[cast].sum() + 1)
            of_good = ((1 - bad)[said].sum() + 0.05) / ((1 - bad)[cast].sum() + 1)
            of_bad, of_good = max(of_bad, of_good), min(of_bad, of_good)
            odds[said] += np.log(of_bad / of_good)
            odds[cast & ~said] += np.log((1 - of_bad) / (1 - of_good))
        bad = 1 / (1 + np.exp(-odds))
    return 1 - bad


def test_quality_stage(stages):
    docs, made = stages[0]
    signals = quality.document_signals(docs.select("doc_id", "text")).drop("text").toPandas()
    kept = _posterior(signals, quality.ROUNDS) >= 0.5
    assert set(_texts(made)) == set(signals["doc_id"][kept].tolist())
    assert 0 < kept.sum() < len(kept)


def test_jaccard_stage(stages):
    docs, made = stages[1]
    rows = sorted(_texts(docs).items())
    want = {c if n else d for d, n, c in components(rows, 80, 100, 5)}
    assert set(_texts(made)) == want and len(want) < len(rows)


def _cut(raw, gone):
    """What is left of a text without the characters all of whose bytes go."""
    out, at = [], 0
    for c in raw.decode():
        n = len(c.encode())
        if not all(gone[at : at + n]):
            out.append(c)
        at += n
    return "".join(out)


def test_repeats_stage(stages):
    docs, made = stages[2]
    want = {}
    for doc_id, (raw, gone) in repeated_bytes(sorted(_texts(docs).items()), 100).items():
        left = _cut(raw, gone)
        if not any(gone) or left.strip():
            want[doc_id] = left
    assert _texts(made) == want


def test_decontamination_stage(session, stages):
    docs, made = stages[3]
    items = [r["text"] for r in session.read.parquet(f"{SF}/benchmark.parquet").collect() if r["text"]]
    item_words = [decontamination.plain_words(pa.array([t]))[0] for t in items]
    want = set()
    for doc_id, text in _texts(docs).items():
        words = decontamination.plain_words(pa.array([text or ""]))[0]
        present = set(words.tolist())
        for item in item_words:
            # A document without enough of an item's words cannot cover it.
            if sum(w in present for w in item.tolist()) < decontamination.COVERAGE * len(item) or not len(item):
                continue
            least = min(decontamination.LEAST_TILE, len(item))
            tiles = decontamination.greedy_tiles(words, item, least)
            if sum(n for *_, n in tiles) >= decontamination.COVERAGE * len(item):
                break
        else:
            want.add(doc_id)
    assert set(_texts(made)) == want


def test_packing_stage(stages):
    docs, made = stages[4]
    tokenizer = Tokenizer.from_file(tokens.vocabulary_path())
    _pieces(made.collect(), tokenizer, list(_texts(docs).items()), 2048)


def test_run_equals_the_stages(session, stages):
    run = corpus_pipeline.run(session, SF)
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, run.select(*kept).collect())) == sorted(
        map(tuple, stages[-1][1].select(*kept).collect())
    )
