from collections import Counter

import pytest

from flowmetrics.llm import sharding


def _table(session, rows):
    return session.createDataFrame(rows, "doc_id bigint, source string, extra string").repartition(5)


@pytest.mark.parametrize("per_bucket", [20_000, 16])
def test_shards_are_even_gapless_and_mixed(session, per_bucket):
    rows = [(i, "hot" if i % 3 else f"s{i % 5}", "x") for i in range(1000)] + [(None, None, None)] * 7
    placed = sharding.stratified_shards(_table(session, rows), 13, rows_per_bucket=per_bucket).collect()
    assert Counter(r["doc_id"] for r in placed) == Counter(r[0] for r in rows)
    sizes = Counter(r["shard"] for r in placed)
    assert set(sizes) == set(range(13)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in placed if r["shard"] == s) == list(range(sizes[s]))
    for source, n in Counter(r[1] for r in rows).items():
        for s in sizes:
            held = sum(r["shard"] == s and r["source"] == source for r in placed)
            assert abs(held - n * sizes[s] / len(rows)) <= 2


def test_many_sources_of_one_row_are_spread(session):
    rows = [(i, "big", "x") for i in range(2000)] + [(2000 + i, f"s{i}", "x") for i in range(2000)]
    placed = sharding.stratified_shards(_table(session, rows), 10, rows_per_bucket=100).collect()
    for s in range(10):
        small = sum(r["shard"] == s and r["source"] != "big" for r in placed)
        assert abs(small - 200) <= 5


def _brute(rows, shards, seed=17):
    """Shard and slot by key, from the hashes alone: the plain way."""
    by_source = {}
    for r in rows:
        by_source.setdefault("n" if r["source"] is None else "s" + r["source"], []).append(r)
    golden = 0.6180339887498949
    order = []
    ranked = sorted(by_source.items(), key=lambda kv: (len(kv[1]), kv[0]))
    for nth, (source, listed) in enumerate(ranked, 1):
        phase = int((nth * golden - int(nth * golden)) * (1 << 20))
        listed.sort(key=lambda r: (r["h"] < 0, r["h"], r["doc_id"]))
        for rank, r in enumerate(listed):
            order.append(((rank * (1 << 20) + phase) / (len(listed) << 20), source, rank, r["doc_id"]))
    order.sort()
    out, slots = {}, Counter()
    for at, (*_, doc_id) in enumerate(order):
        shard = at * shards // len(order)
        out[doc_id] = (shard, slots[shard])
        slots[shard] += 1
    return out


@pytest.mark.parametrize("per_bucket", [20_000, 25])
def test_order_equals_brute_force(session, per_bucket):
    sources = ["hot"] * 50 + ["a", "b", None, "é"]
    table = _table(session, [(i, sources[i * 7 % 54], "x") for i in range(700)])
    hashed = table.selectExpr("doc_id", "source", "xxhash64(17, doc_id) AS h").collect()
    placed = sharding.stratified_shards(table, 9, rows_per_bucket=per_bucket).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in placed} == _brute(hashed, 9)


def test_result_depends_on_rows_only(session):
    rows = [(i, f"s{i % 3}", str(i)) for i in range(300)]
    one = sharding.stratified_shards(_table(session, rows), 7).collect()
    two = sharding.stratified_shards(_table(session, rows[::-1]).repartition(2), 7, rows_per_bucket=20).collect()
    place = lambda out: {r["doc_id"]: (r["shard"], r["slot"]) for r in out}
    assert place(one) == place(two)
    other = sharding.stratified_shards(_table(session, rows), 7, seed=18).collect()
    assert place(other) != place(one)


def test_few_rows_and_clashing_names(session):
    rows = _table(session, [(1, "a", "x"), (2, "b", "y")]).withColumnRenamed("extra", "slot")
    out = sharding.stratified_shards(rows, 40)
    assert sorted(out.columns) == ["doc_id", "shard", "slot", "source"]
    assert sorted(tuple(r) for r in out.select("doc_id", "slot").collect()) == [(1, 0), (2, 0)]
    assert sharding.stratified_shards(_table(session, []), 4).collect() == []


def test_written_shards(session, tmp_path):
    rows = [(i, f"s{i % 2}", "x") for i in range(50)]
    sharding.write_shards(_table(session, rows), str(tmp_path / "shards"), 4)
    assert sorted(p.name for p in (tmp_path / "shards").glob("shard=*")) == [f"shard={i}" for i in range(4)]
    assert session.read.parquet(str(tmp_path / "shards")).count() == 50
