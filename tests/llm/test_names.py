"""Columns of the documents that are named like those an operator works with."""

import pytest

from flowmetrics.llm import decontamination, jaccard_join, quality, repeats, url_filter

# What the operators call their own columns, in any case.
NAMES = (
    "doc tie twin spans gram whole first home kind n_bytes row item seed seeds text_key item_id item_text _doc _key "
    "node _node _nodes _stands stands component component_id tokens token id u v n prefix second host_ "
    "_address _alias_verdict rule_verdict rule_host rule_path best spread url_ node_ signal n_words votes kept p_good "
    "column0 Doc TIE"
).split()
TEXTS = [
    "the quick brown fox jumps over the lazy dog and runs far away from here " * 3,
    "the quick brown fox jumps over the lazy dog and runs far away from here " * 3,
    "an item of the benchmark that stands alone in this text and is long enough to see",
    None, "", "short one",
]


@pytest.fixture(scope="module")
def table(session):
    names = [n for n in dict.fromkeys(NAMES)]
    fields = ", ".join(["doc_id bigint", "text string", *[f"`{n}` string" for n in names if n.lower() not in {"doc", "tie"} or n.islower()]])
    kept = [n for n in names if n.lower() not in {"doc", "tie"} or n.islower()]
    rows = [(i, t, *[f"{n}{i}" for n in kept]) for i, t in enumerate(TEXTS)]
    return session.createDataFrame(rows, fields).repartition(2)


def _as_given(df, table):
    assert df.columns == table.columns and df.dtypes == table.dtypes
    got = {r["doc_id"]: tuple(r)[2:] for r in df.collect()}
    given = {r["doc_id"]: tuple(r)[2:] for r in table.collect()}
    assert all(given[k] == v for k, v in got.items())
    return got


def test_repeats_leave_other_columns(table):
    assert set(_as_given(repeats.without_repeats(table), table)) == {0, 2, 3, 4, 5}


def test_jaccard_groups_leave_other_columns(table):
    assert set(_as_given(jaccard_join.one_per_component(table, 80, 100, 5), table)) == {0, 2, 3, 4, 5}


def test_decontamination_leaves_other_columns(session, table):
    items = session.createDataFrame([(1, TEXTS[2])], "item_id bigint, text string")
    assert set(_as_given(decontamination.without_contaminated(table, items), table)) == {0, 1, 3, 4, 5}


def test_quality_leaves_other_columns(session, table):
    import corpus_pipeline

    _as_given(corpus_pipeline.quality_rules(session, table, ""), table)


def test_pages_leave_other_columns(session, table):
    new = {"host", "path", "rule", "verdict"}
    pages = table.drop(*new).withColumnRenamed("text", "html").selectExpr(
        "*", "concat('http://a.example.org/es/', doc_id) AS url"
    )
    rules = url_filter.rules_table(session, [("example.org", "/es/", "block")])
    judged = url_filter.judged_pages(pages, rules)
    assert judged.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    assert sorted(map(str, judged.select(*[f"`{c}`" for c in pages.columns]).collect())) == sorted(map(str, pages.collect()))
    assert {r["verdict"] for r in judged.collect()} == {"block"}
