"""Reply trees as formatted conversations: paths from root to leaf, the best branches chosen.

Paths are found by self-joins that double their reach: after k rounds a message knows its 2**k-th
ancestor and the scores between, so a tree of any depth takes a logarithm of rounds, and messages
that have reached their root take no part in further ones. Leaves
are ranked by the mean score of their path, and the messages of the chosen ones are gathered by the
same tables. Each path becomes one text with marks around turns and a loss mask over what the
assistant says.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowmetrics.sources.scratch import scratch_path, written

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END), re.DOTALL)


def escape(text: str) -> str:
    """The text without control strings: a backslash parts the two signs they begin with."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL)


def _role(role: str) -> str:
    """A role stands in one line."""
    return escape(role).replace("\n", "\\n")


def best_paths(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """``tree``, ``leaf``, ``rank`` (from 1), ``node`` and ``place`` (from 0) of chosen paths.

    ``messages``: ``tree`` and ``node`` (not NULL), ``parent`` and ``score``. A message whose
    parent is NULL or missing is a root. Of messages that share tree and node one is looked at.
    Leaves are ranked in their tree by mean path score, NULL scores counting 0, then by node;
    ``best=None`` takes all. Messages on or below a cycle have no root and are on no path.
    """
    spark = messages.sparkSession
    key = ["tree", "node"]
    own = messages.groupBy(*key).agg(F.min(F.struct("parent", "score")).alias("m")).select(
        *key, F.col("m.parent").alias("parent"), F.coalesce("m.score", F.lit(0.0)).alias("score")
    )
    own = written(own, scratch_path(spark, "messages"))
    known = own.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    step = own.join(known, ["tree", "parent"], "left").select(
        *key, F.when(F.col("known"), F.col("parent")).alias("up"), "score",
        F.lit(1).cast("bigint").alias("n"),
    )
    first = written(step, scratch_path(spark, "ancestors"))
    reached, active = [first.where("up IS NULL")], first.where("up IS NOT NULL")
    steps = []  # by round: who is how far above whom, for those that have someone there
    most = own.count().bit_length() + 1
    while len(steps) <= most and not active.isEmpty():
        steps.append(active)
        known_so_far = reduce(DataFrame.unionByName, [*reached, active])
        above = known_so_far.select(
            "tree", F.col("node").alias("up"), F.col("up").alias("next"),
            F.col("score").alias("more"), F.col("n").alias("m"),
        )
        doubled = active.join(above, ["tree", "up"]).select(
            *key, F.col("next").alias("up"), (F.col("score") + F.col("more")).alias("score"),
            (F.col("n") + F.col("m")).alias("n"),
        )
        doubled = written(doubled, scratch_path(spark, "ancestors"))
        reached.append(doubled.where("up IS NULL"))
        active = doubled.where("up IS NOT NULL")
    rooted = reduce(DataFrame.unionByName, reached)
    parents = first.where("up IS NOT NULL").select("tree", F.col("up").alias("node")).distinct()
    leaves = rooted.join(parents, key, "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("score") / F.col("n")), "node")
    ranked = leaves.withColumn("rank", F.row_number().over(order))
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    on_path = ranked.select(
        "tree", F.col("node").alias("leaf"), "rank", "node", (F.col("n") - 1).alias("place")
    )
    on_path = written(on_path, scratch_path(spark, "paths"))
    for k, table in enumerate(steps):
        up = table.select(*key, "up")
        moved = on_path.join(up, key).select(
            "tree", "leaf", "rank", F.col("up").alias("node"), (F.col("place") - 2**k).alias("place")
        )
        on_path = written(on_path.unionByName(moved), scratch_path(spark, "paths"))
    return on_path


def formatted(turns: DataFrame) -> DataFrame:
    """One row per path: ``tree``, ``rank``, ``text`` and ``loss``, (from, to) in code points.

    ``turns``: ``tree``, ``rank``, ``place``, ``role``, ``text``; NULL roles and texts are empty.
    Rows are sorted by path, and a task holds one path at a time.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, loss, length = None, [], [], 0
        done: list[tuple] = []
        held = 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("tree", "rank", "role", "text"))
            for tree, rank, role, text in zip(*columns):
                if (tree, rank) != now:
                    if now is not None:
                        done.append((*now, "".join(parts), loss))
                        held += length
                    now, parts, loss, length = (tree, rank), [], [], 0
                    if held > 4 << 20:
                        yield _paths(done)
                        done, held = [], 0
                head, body = f"{START}{_role(role or '')}\n", escape(text or "")
                if role == ASSISTANT:
                    begin = length + len(head)
                    loss.append({"from": begin, "to": begin + len(body)})
                parts += [head, body, END]
                length += len(head) + len(body) + len(END)
        if now is not None:
            done.append((*now, "".join(parts), loss))
        if done:
            yield _paths(done)

    keyed = turns.select("tree", "rank", "place", "role", "text")
    dealt = keyed.repartition("tree", "rank").sortWithinPartitions("tree", "rank", "place")
    return dealt.mapInArrow(
        lines, "tree string, rank int, text string, loss array<struct<from: bigint, to: bigint>>"
    )


def _paths(done: list[tuple]) -> pa.RecordBatch:
    spans = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
    kinds = [pa.string(), pa.int32(), pa.string(), spans]
    columns = [pa.array(c, k) for c, k in zip(zip(*done), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["tree", "rank", "text", "loss"])


def parsed(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted path."""
    return [(unescape(role), unescape(body)) for role, body in _TURN.findall(text)]


def linear_conversations(rows: DataFrame) -> DataFrame:
    """Rows by turn as messages that each answer the one before: ``tree``, ``node``, ``parent``,
    ``score``, ``role``, ``text``. Rows that share a turn are ordered by role and text; NULL turns
    come first, and rows with a NULL id are one conversation."""
    named = rows.select(
        F.when(F.col("conv_id").isNull(), "none").otherwise(F.col("conv_id").cast("string")).alias("tree"),
        "turn", "role", "text",
    )
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    numbered = named.withColumn("node", F.row_number().over(order).cast("bigint"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1).alias("parent")
    return numbered.select("tree", "node", parent, F.lit(0.0).alias("score"), "role", "text")


def format_trees(messages: DataFrame, path: str, best: int | None = 1) -> None:
    """Choose paths of reply trees and write them as formatted conversations in Parquet.

    ``messages`` as for :func:`best_paths` with ``role`` and ``text``. An empty table gives none.
    """
    spark = messages.sparkSession
    kept = written(messages, scratch_path(spark, "messages"))
    paths = best_paths(kept.select("tree", "node", "parent", "score"), best)
    texts = kept.groupBy("tree", "node").agg(F.min(F.struct("parent", "score", "role", "text")).alias("m"))
    texts = texts.select("tree", "node", "m.role", "m.text")
    formatted(paths.join(texts, ["tree", "node"])).write.parquet(path)


def read_digests(conversations: DataFrame) -> DataFrame:
    """Digests of formatted conversations, all from the written text and mask: ``tree``, ``rank``,
    ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, loss in zip(batch.column("text").to_pylist(), batch.column("loss").to_pylist()):
                turns, taught = hashlib.sha256(), hashlib.sha256()
                found = parsed(text)
                for role, body in found:
                    turns.update(f"{role}\n{body}\n".encode())
                masked = [unescape(text[s["from"] : s["to"]]) for s in loss]
                for body in masked:
                    taught.update(body.encode())
                out.append(
                    (len(found), turns.hexdigest(), sum(map(len, masked)), taught.hexdigest(), len(text))
                )
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 5, kinds)]
            names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("rank"), *columns], names=["tree", "rank", *names]
            )

    return conversations.mapInArrow(
        digest,
        "tree string, rank int, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )
