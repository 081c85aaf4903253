from collections import Counter
from itertools import permutations

import pyarrow as pa
import pytest

from flowmetrics.llm import filter_audit
from tests.llm.brute import WORD

LABELS = "doc_id bigint, quality int, toxic int"


def brute_mask(rows, doc_id, text):
    text = text or ""
    words = WORD.findall(text)
    failed = [
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
        any(c in "#$%&*|" for c in text),
        doc_id is not None and any((t or "") == text and d is not None and d < doc_id for d, t, _ in rows),
    ]
    return "".join(letter for letter, f in zip("ABCDE", failed) if f)


def brute_audit(rows, labels):
    out = {}
    masked = [(part or "", brute_mask(rows, d, t), labels.get(d, (0, 0))) for d, t, part in rows]
    for part in {m[0] for m in masked}:
        mine = [m for m in masked if m[0] == part]
        share = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [m for m in left if letter in m[1]]
                left = [m for m in left if letter not in m[1]]
                fails = [m for m in mine if letter in m[1]]
                share[letter] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), len(fails) - len(gone), sum(m[1] == letter for m in mine),
                    sum(m[2][0] == 1 for m in gone), sum(m[2][1] == 1 for m in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(share[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in df.collect()}


def prose(n, k=1):
    return " ".join(f"w{i % (n // k)}" for i in range(n))


ROWS = [
    (1, prose(250), "en"), (2, prose(250), "en"), (2, prose(250), "de"), (3, prose(250), None),
    (4, prose(300, 4), "en"), (5, prose(300, 4) + " $", "en"), (6, None, "en"), (7, "", "de"),
    (8, "SHOUT", "de"), (None, prose(250), "en"), (None, "", ""), (9, "é" * 40 + " AB", "en"),
    (10, " \x0b\t\n", "en"), (11, prose(60_000), "en"), (12, "A b # ß " * 90, "de"), (12, "A b # ß " * 90, "de"),
]
GIVEN = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (5, 0, 1), (6, None, None), (8, 1, 1), (None, 1, 1), (99, 1, 1)]


@pytest.fixture
def audit(session):
    def run(rows, labels=GIVEN, extra=""):
        docs = session.createDataFrame(rows, f"doc_id bigint, text string, lang string{extra}").repartition(3)
        return audited(filter_audit.audit_filters(docs, session.createDataFrame(labels, LABELS)))

    return run


def test_audit_equals_brute_force(audit):
    labels = {1: (1, 0), 2: (1, 1), 5: (0, 1), 8: (1, 1)}
    got = audit(ROWS)
    assert got == brute_audit(ROWS, labels)
    assert len(got) == 600 * 3  # en, de and the empty part


def test_other_columns_are_not_read(audit):
    rows = [(*r, "x", 1, "y", True, 3) for r in ROWS]
    assert audit(rows, extra=", part string, mask int, h string, first boolean, kept int") == audit(ROWS)


def test_empty_tables(audit):
    assert audit([]) == {}
    assert audit(ROWS, []) == brute_audit(ROWS, {})


def test_fields_hold_any_count(session):
    """Sums that fill a field to its last bit do not reach into the next one."""
    fields = filter_audit.Fields("AB", (10**12).bit_length())
    counts, documents = fields.unpacked(10**12 * fields.packed(3))
    assert documents == 10**12 and counts.tolist() == [[10**12, 0], [10**12, 0]]
    rows = session.range(5000).selectExpr("'p' AS part", "31 AS mask", "true AS good", "id % 2 = 0 AS toxic")
    got = audited(filter_audit.filter_interactions(rows))
    assert got["p", "BACDE", 1] == (0, 5000, 0, 0, 5000, 2500, 24 * 5000)
    assert got["p", "BACDE", 2] == (0, 0, 5000, 0, 0, 0, 24 * 5000)


def test_many_parts_and_few_filters(session):
    rows = session.range(3000).selectExpr("cast(id % 1500 AS string) AS part", "int(id % 2) AS mask", "false AS good", "false AS toxic")
    got = audited(filter_audit.filter_interactions(rows, "XY"))
    assert len(got) == 1500 * 4
    assert got["1", "YX", 2] == (0, 2, 0, 2, 0, 0, 4) and got["2", "XY", 1] == (2, 0, 0, 0, 0, 0, 0)
    with pytest.raises(ValueError):
        filter_audit.filter_interactions(rows, "ABCDEFG")


def test_masks_of_a_slice():
    column = pa.array(["x", None, "A#", prose(500, 5)])
    assert filter_audit.text_masks(column).tolist() == [1, 1, 13, 2]
    assert filter_audit.text_masks(column.slice(2)).tolist() == [13, 2]
