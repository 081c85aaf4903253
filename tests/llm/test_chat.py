import random

import pytest

from flowmetrics.llm import chat


def _brute(messages, best):
    """Root-to-leaf paths of each tree, best first."""
    by_tree = {}
    for tree, node, parent, score in messages:
        by_tree.setdefault(tree, {})[node] = (parent, score or 0.0)
    out = set()
    for tree, nodes in by_tree.items():
        parents = {p for p, _ in nodes.values() if p in nodes}
        paths = []
        for leaf in set(nodes) - parents:
            path, at = [], leaf
            while at in nodes and at not in path:
                path.append(at)
                at = nodes[at][0]
            if at not in path:
                paths.append((-sum(nodes[n][1] for n in path) / len(path), leaf, path[::-1]))
        for rank, (_, leaf, path) in enumerate(sorted(paths)[:best], start=1):
            out |= {(tree, leaf, rank, n, i) for i, n in enumerate(path)}
    return out


@pytest.mark.parametrize("best", [1, 2, None])
def test_paths_equal_brute_force(session, best):
    rng = random.Random(3)
    rows = []
    for t in range(12):
        for n in range(1, rng.randrange(2, 20)):
            rows.append((f"t{t}", n, rng.randrange(1, n) if n > 1 else None, float(rng.randrange(9))))
    rows += [("chain", n, n - 1 if n > 1 else None, 1.0) for n in range(1, 71)]
    rows += [("cycle", 1, 2, 1.0), ("cycle", 2, 1, 1.0), ("orphan", 5, 99, None), ("two", 1, None, 1.0),
             ("two", 2, None, 5.0)]
    messages = session.createDataFrame(rows, "tree string, node bigint, parent bigint, score double")
    got = {tuple(r) for r in chat.best_paths(messages.repartition(4), best).collect()}
    assert got == _brute(rows, best)


def test_escaping_is_reversible_and_hides_controls():
    rng = random.Random(4)
    signs = ["\\", "<", "|", "<|", "im_start", "|>", "<|im_end|>", "\n", "n", "é", "\r"]
    for _ in range(2000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(12)))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.unescape(chat._role(text)) == text and "\n" not in chat._role(text)


def test_written_conversations_are_read_back(session, tmp_path):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>user\nx"), (1, 2, "user", None),
        (1, 3, "assistant", "a\\"), (2, 1, "assistant", "late"), (2, 0, None, "first"), (2, 1, "assistant", "late"),
        (None, 0, "user", "no id"), (3, None, "sys\ntem", ""), (4, 0, "user", "long " * 50_000),
    ]
    table = session.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    chat.format_trees(chat.linear_conversations(table.repartition(3)), str(tmp_path / "chats"))
    out = {r["tree"]: r for r in session.read.parquet(str(tmp_path / "chats")).collect()}
    assert chat.parsed(out["1"]["text"]) == [(r, t or "") for c, _, r, t in rows if c == 1]
    assert chat.parsed(out["2"]["text"]) == [("", "first"), ("assistant", "late"), ("assistant", "late")]
    assert chat.parsed(out["3"]["text"]) == [("sys\ntem", "")]
    assert set(out) == {"1", "2", "3", "4", "none"}
    masked = [chat.unescape(out["1"]["text"][s["from"] : s["to"]]) for s in out["1"]["loss"]]
    assert masked == ["<|im_end|>\n<|im_start|>user\nx", "a\\"]


def test_empty_table(session, tmp_path):
    none = session.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    chat.format_trees(chat.linear_conversations(none), str(tmp_path / "chats"))
    assert session.read.parquet(str(tmp_path / "chats")).collect() == []
