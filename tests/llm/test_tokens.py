import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from flowmetrics.llm import packing, token_files, tokens

ROWS = [(5, "Hello, world! it's"), (1, None), (2, ""), (3, "a " * 5000), (3, "other text"), (5, "Hello, world! it's"),
        (None, "no id"), (9, "<|endoftext|> é日本 \t x"), (7, " "), (8, "Ünïcödé " * 900)]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.vocabulary_path())


def _ids(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def test_ids_are_the_tokenizers(tokenizer):
    rng = random.Random(2)
    signs = ["a", "B", "é", "É", "ß", "'s", "'", "Σ", "İ", "\u0301", "日", "9", "½", "<|endoftext|>", " ", "\t",
             "\u00a0", "\u2003", ".", "&", "_", "😀", "ª", "fi"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(25))) for _ in range(3000)]
    ids, ends = tokens.WordEncoder(tokens.vocabulary_path()).encode(pa.array([*texts, None]))
    starts = np.concatenate(([0], ends))
    for text, a, b in zip([*texts, ""], starts, ends):
        assert tokenizer.encode(text, add_special_tokens=False).ids == ids[a:b].tolist()


def test_a_small_cache_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 3)
    encoder = tokens.WordEncoder(tokens.vocabulary_path())
    for _ in range(2):
        ids, _ = encoder.encode(pa.array(["one two, three four. five", "two six one"]))
        assert ids.tolist() == tokenizer.encode(
            "one two, three four. five two six one", add_special_tokens=False).ids


def test_token_files_are_read_back(session, documents, tokenizer, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_token_files(documents(ROWS, 4), path, end_id=2)
    got = token_files.read_token_files(session, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in ROWS), key=lambda d: (d is not None, d))
    start = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (start, len(r["ids"]))
        start += r["n_tokens"]
    want = sorted(((d, _ids(tokenizer, t, 2)) for d, t in ROWS), key=str)
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=str) == want
    crc = token_files.with_crc32(token_files.read_token_files(session, path)).collect()
    assert {(r["doc_id"], r["ids_crc32"]) for r in crc} == {
        (d, zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in want}
    assert {r["n_tokens"] for r in token_files.read_document(session, path, 3).collect()} == {5001, 3}


def test_reading_back_shuffles_no_ids(session, documents, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_token_files(documents(ROWS, 4), path, end_id=2)
    df = token_files.read_token_files(session, path)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    for line in text.splitlines():
        assert "Exchange hashpartitioning" not in line


def test_row_groups_and_pages_keep_their_bounds(session, documents, tmp_path):
    """A filter on the document id opens few row groups, and values lie in many small pages."""
    rows = [(i, f"word{i % 700} and some more of {i} " * 40) for i in range(9000)]
    path = tmp_path / "ids"
    session.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        with pytest.MonkeyPatch.context() as patch:
            patch.setitem(token_files.FILE_OPTIONS, "parquet.block.size", str(256 << 10))
            token_files.write_token_files(documents(rows, 4), str(path), end_id=2)
    finally:
        session.conf.set("spark.sql.shuffle.partitions", "8")
    files = sorted(path.glob("*.parquet"))
    groups, hit = [], 0
    for file in files:
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            ids, doc = group.column(4), group.column(0)
            groups.append(ids.total_uncompressed_size)
            assert "RLE_DICTIONARY" in ids.encodings and ids.has_dictionary_page
            assert ids.has_offset_index and doc.has_column_index
            hit += doc.statistics.min <= 4321 <= doc.statistics.max
    assert len(groups) >= 4 and max(groups) <= 1 << 20 and hit == 1
    found = token_files.read_document(session, str(path), 4321)
    assert found.count() == 1
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,4321)" in text.split("PushedFilters")[1]


def test_empty_token_files(session, documents, tmp_path):
    token_files.write_token_files(documents([]), str(tmp_path / "ids"), 2)
    assert token_files.read_token_files(session, str(tmp_path / "ids")).collect() == []


def _pieces(out, tokenizer, rows, capacity):
    used = {}
    for r in out:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for taken in used.values():
        at = 0
        for offset, length in sorted(taken):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(used) == set(range(len(used)))
    want = []
    for d, t in rows:
        ids = _ids(tokenizer, t, 1)
        for a in range(0, len(ids), capacity):
            cut = np.array(ids[a : a + capacity], "<u4")
            want.append((d, a, len(cut), zlib.crc32(cut.tobytes()), len(ids)))
    got = [tuple(r[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    return used


@pytest.mark.parametrize("capacity", [2048, 16])
def test_packing_places_every_id_once(session, documents, tokenizer, capacity):
    rows = ROWS + [(100 + i, "word " * (i * 7 % 23)) for i in range(150)]
    out = packing.pack_documents(documents(rows, 6), capacity=capacity).collect()
    used = _pieces(out, tokenizer, rows, capacity)
    total = sum(r["length"] for r in out)
    assert len(used) <= total / capacity * 1.05 + 1


def test_empty_packing(session, documents):
    assert packing.pack_documents(documents([])).collect() == []


def test_tasks_of_a_worker_share_its_encoder(monkeypatch):
    """Memory that loading the tokenizer takes is not all given back, so it is loaded once."""
    made, cuts = [], []
    load = tokens.WordEncoder.__init__

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, cut, _):
            cuts.append(cut)

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(tokens.WordEncoder, "__init__", lambda self, path: made.append(load(self, path)))
    monkeypatch.setattr(packing, "TaskContext", Task)
    tokens.process_encoder.cache_clear()
    packing.token_pieces(Docs(), 1)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words", None]})
    first, second = (list(cuts[0](iter([batch]))) for _ in range(2))
    tokens.process_encoder.cache_clear()
    assert first == second and first[0].num_rows == 2
    assert len(made) == 1


def test_closest_fill_equals_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        counts = {rng.randrange(1, 15): rng.randrange(0, 4) for _ in range(rng.randrange(0, 4))}
        space = rng.randrange(0, 40)
        taken = packing.closest_fill(counts, space)
        assert all(k <= counts[n] for n, k in taken.items())
        sums = {sum(n * k for n, k in zip(counts, ks))
                for ks in itertools.product(*(range(c + 1) for c in counts.values()))}
        assert sum(n * k for n, k in taken.items()) == max(s for s in sums if s <= space)


def test_plan_uses_every_piece():
    counts = {2048: 3, 1500: 40, 548: 17, 3: 1000, 700: 9}
    plan = packing.plan_windows(counts)
    fill = np.zeros(plan.windows, np.int64)
    for n, c in counts.items():
        window, offset = plan.place(np.full(c, n), np.arange(c))
        np.add.at(fill, window, n)
        assert (offset + n <= 2048).all()
    assert fill.sum() == sum(n * c for n, c in counts.items()) and fill.max() <= 2048
