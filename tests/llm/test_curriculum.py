import random
from collections import defaultdict

import pytest

from flowmetrics.llm import curriculum
from tests.llm.brute import WORD

DOCS = "doc_id bigint, text string, source string"
FLAT = [(0.0, 1.0)]


def make_rows(n, hot=0.4):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < hot else rng.choice(["a", "b", "c", None])
        rows.append((i, "w " * rng.randrange(0, 30), source))
    return [*rows, (None, "null id here", "a"), (None, None, "b"), (5, "again and again", "hot"), (5, "again and again", "hot")]


def water_fill(sizes, weights, share, most):
    """Targets by sharing out again and again what the limits leave over."""
    target, open_ = dict.fromkeys(sizes, 0.0), {s for s in sizes if weights.get(s)}
    left = share * sum(sizes.values())
    while open_:
        unit = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if most * sizes[s] <= weights[s] * unit}
        for s in over or open_:
            target[s] = most * sizes[s] if over else weights[s] * unit
        left -= sum(target[s] for s in over)
        open_ = open_ - over if over else set()
    return target


def area(corners, t):
    """The integral of a polygon up to t, by small steps of its exact trapezes."""
    ends = [(0.0, corners[0][1]), *corners, (1.0, corners[-1][1])]
    out = 0.0
    for (t0, w0), (t1, w1) in zip(ends, ends[1:]):
        if t <= t0 or t1 == t0:
            continue
        u = min(t, t1)
        wu = w0 + (w1 - w0) * (u - t0) / (t1 - t0)
        out += (w0 + wu) / 2 * (u - t0)
    return out


@pytest.fixture
def mixed(session):
    def run(rows, shapes, parts=4, extra="", **how):
        docs = session.createDataFrame(rows, DOCS + extra).repartition(parts)
        corners = [(s, t, w) for s, shape in shapes.items() for t, w in shape]
        schedule = session.createDataFrame(corners, "source string, time double, weight double")
        return curriculum.mixed_documents(docs, schedule, **how)

    return run


SHAPES = {
    "hot": [(0.0, 4.5), (1.0, 1.5)], "a": FLAT, "b": [(0.0, 0.0), (0.5, 2.0), (0.75, 0.0)],
    "c": [(0.25, 1.0), (0.25, 5.0)], None: [(0.0, 0.0), (1.0, 2.0)], "absent": FLAT,
}


@pytest.mark.parametrize("share,most", [(1.5, 2.0), (0.3, 1.0), (2.9, 3.0), (9.0, 2.0)])
def test_mix_follows_the_schedules(mixed, share, most):
    rows = make_rows(400)
    mix = mixed(rows, SHAPES, share=share, most=most).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    weights = {s: area(shape, 1.0) for s, shape in SHAPES.items()}
    target = water_fill(sizes, weights, share, most)
    for r in mix:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["words"] or 0
    for source in sizes:
        assert taken[source] == pytest.approx(target[source], abs=1.001)
    # Copies begin when the words before them in their source have been demanded.
    order = sorted((r for r in mix if r["place"] is not None), key=lambda r: r["place"])
    assert [r["place"] for r in order] == list(range(len(order)))
    assert [r["position"] for r in order] == sorted(r["position"] for r in order)
    before = defaultdict(int)
    for r in order:
        s = r["source"]
        assert area(SHAPES[s], r["position"]) / weights[s] * target[s] == pytest.approx(before[s], abs=1e-6 * sizes[s])
        before[s] += r["words"]
        assert r["words"] == r["size"] or before[s] == int(target[s] + 1e-9)
    # Every row is there, and none more often than the limit says.
    per_row = defaultdict(list)
    for r in mix:
        per_row[r["at"]].append(r)
    assert len(per_row) == len(rows)
    for copies in per_row.values():
        assert sum(r["words"] or 0 for r in copies) <= most * copies[0]["size"]


def test_rows_decide_not_where_they_lie(mixed):
    rows = make_rows(150)
    shown = lambda df: sorted((str(r["doc_id"]), r["source"] or "", r["copy"], r["words"], r["position"], r["place"]) for r in df.collect() if r["place"] is not None)
    assert shown(mixed(rows, SHAPES, parts=1)) == shown(mixed(rows[::-1], SHAPES, parts=9))
    assert shown(mixed(rows, SHAPES, seed=30)) != shown(mixed(rows, SHAPES))


def test_sources_without_schedule_words_or_rows(mixed):
    assert mixed([], SHAPES).collect() == []
    assert curriculum.taken_by_document(mixed([(1, "a b", "x")], SHAPES)).first()["taken"] == 0
    rows = [(1, None, "a"), (2, " \n", "a"), (3, "one two", "b")]
    got = {r["doc_id"]: r for r in curriculum.taken_by_document(mixed(rows, SHAPES)).collect()}
    assert [got[i]["taken"] for i in (1, 2, 3)] == [0, 0, 3]  # 1.5 x 2 words, all from b
    assert got[3]["copies"] == 2 and got[1]["first_place"] is None


def test_clashing_names_and_long_texts(mixed):
    extra = ", size int, hash string, key string, part int, whole double, pieces int, copy int, words int, place int"
    rows = [(*r, 1, "x", "y", 2, 3.0, 4, 5, 6, 7) for r in [(1, "w " * 300_000, "a"), (2, "a b", "b"), (3, "a", None)]]
    got = {r["doc_id"]: (r["size"], r["taken"]) for r in curriculum.taken_by_document(mixed(rows, SHAPES, extra=extra)).collect()}
    assert got[1][0] == 300_000 and got[2] == (2, 4) and got[3] == (1, 2)


def test_many_sources_of_one_row(session, mixed):
    rows = [(i, "a b c d", f"s{i}") for i in range(500)] + [(i, "a b", "big") for i in range(500, 1500)]
    mix = mixed(rows, {"big": FLAT, **{f"s{i}": FLAT for i in range(500)}})
    taken = curriculum.taken_by_document(mix).groupBy().sum("taken").first()[0]
    assert taken == 1.5 * 4000


def test_cycled_schedule_and_written_mix(session, tmp_path):
    rows = make_rows(60)[:60]
    docs = session.createDataFrame(rows, DOCS)
    sized = curriculum.sized_documents(docs, 1)
    schedule = curriculum.cycled_schedule(sized, [[(0.0, 3.0)], [(0.0, 1.0)], [(0.0, 2.0)]])
    assert {r["source"]: r["weight"] for r in schedule.collect()} == {"a": 3, "b": 1, "c": 2, "hot": 3, None: 1}
    mix = curriculum.mixed_documents(docs, schedule, sized=sized)
    curriculum.write_mix(docs, mix, str(tmp_path / "mix"))
    back = session.read.parquet(str(tmp_path / "mix"))
    assert back.count() == mix.where("place IS NOT NULL").count()
    assert back.where("size(split(trim(text), ' +')) < mix_words").count() == 0
