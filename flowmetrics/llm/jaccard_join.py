"""Documents linked by the Jaccard similarity of their word shingles, and their link components.

Two sets as similar as the threshold share a token among the first few of each under any order of
all tokens. Under each order here, tokens seen to repeat come last and the rest by a hash of its
own. Documents that share a token of the first prefix are candidates if they also share one of the
second, and if their parity bits differ in no more places than their sets may; before the sets of a
pair are compared, they must share one under a third. All these filters are necessary conditions,
so their intersection loses no link.

Equal sets count as one node. Candidates of small token groups are pairs of rows; a large group is
split into blocks by hash, and one task compares two blocks, skips what is connected already and
returns connecting links only. Parity bits, as many as a set has tokens, say beforehand which nodes
of a large group have a partner there at all; the sets of the others are not read again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmetrics.llm.batches import mixed, slices, split_words, window_hashes, word_hashes
from flowmetrics.llm.bits import filter_bits, passes
from flowmetrics.llm.columns import apart, together
from flowmetrics.llm.components import connected_components
from flowmetrics.sources.scratch import discard, scratch_path, written

#: Repeating tokens whose counts order them last; the most frequent ones, 16 bytes each.
ORDERED_TOKENS = 1 << 18
#: A group of at most so many nodes is compared by pair rows, so a row makes at most so many.
SMALL_GROUP = 24
#: Tokens of the sets that one block of a large group holds, on average.
BLOCK_TOKENS = 400_000
#: Blocks of a cluster of large groups that is compared as one.
CLUSTER_BLOCKS = 16
#: Nodes in a block of a large group whose parity bits are compared, and its tokens, in blocks of sets.
ALIKE_BLOCK = 2048
ALIKE_TOKENS = 64
#: Salts of the orders that candidates must also agree under.
OTHER_ORDERS = (0x5851F42D4C957F2D, 0x2545F4914F6CDD1D)
#: Rounds in which nodes are compared with one partner each before all pairs left are.
PICKING_ROUNDS = 4
#: 64-bit integers of parity bits that stand beside a set.
PARITY_WORDS = 8


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of ``width`` words; of all words if there are fewer."""
    ends, words = split_words(column, lower=True)
    hashes = word_hashes(words)
    windows = window_hashes(hashes, width)
    sets = []
    start = 0
    for end in ends.tolist():
        n = end - start
        if n >= width:
            sets.append(np.unique(windows[start : end - width + 1]))
        elif n:
            sets.append(mixed(window_hashes(hashes[start:end], n) + np.uint64(n)))
        else:
            sets.append(np.zeros(0, np.uint64))
        start = end
    return sets


def fingerprint(tokens: np.ndarray) -> int:
    """64 bits that stand for a set; two different sets share them with a chance of 2**-64."""
    return int.from_bytes(blake2b(tokens.tobytes(), digest_size=8).digest(), "big", signed=True)


class Threshold:
    """The least similarity as a fraction, ``num / den``."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den

    def prefix(self, n: int) -> int:
        """How many tokens of a set of ``n`` must be looked at under one order."""
        return n - -(-self.num * n // self.den) + 1

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return self.den * both >= self.num * (len(a) + len(b) - both)

    def sizes_fit(self, n: int | np.ndarray, m: int | np.ndarray) -> bool | np.ndarray:
        return (self.den * n >= self.num * m) & (self.den * m >= self.num * n)


def _first(tokens: np.ndarray, count: int, salt: int) -> np.ndarray:
    """The first ``count`` tokens under the order of a salted hash."""
    keys = mixed(tokens ^ np.uint64(salt))
    if count >= len(keys):
        return np.sort(keys)
    return np.sort(np.partition(keys, count - 1)[:count])


def _share(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted arrays have a common element."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return bool((b[at] == a).any()) if len(b) else False


def repeating_tokens(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that slices of the table repeat, and how often: the most frequent ones, by token.

    They only order the prefixes, so counts need not be complete; any order is right.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            distinct = {s.tobytes(): s for s in shingle_sets(batch.column("text"), width) if len(s)}
            if not distinct:
                continue
            tokens, n = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
            often = n > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[often].view(np.int64)), pa.array(n[often])], names=["token", "n"]
            )

    counted = docs.select("text").mapInArrow(count, "token bigint, n bigint")
    summed = counted.groupBy("token").agg(F.sum("n").alias("n")).where("n >= 12")
    top = summed.orderBy(F.desc("n"), "token").limit(ORDERED_TOKENS).toArrow()
    tokens = top.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top.column("n").to_numpy()[order]


def parity(tokens: np.ndarray) -> np.ndarray:
    """``PARITY_WORDS`` integers whose bits tell of how many of the set's tokens fall on each, odd or
    even. Where two sets' bits differ, a token is in one of them only, so the bits that differ are no
    more than the tokens that do."""
    odd = np.bincount((tokens >> np.uint64(17)) % np.uint64(64 * PARITY_WORDS), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


PARITY = [f"p{i}" for i in range(PARITY_WORDS)]


def scaled_parity(tokens: np.ndarray) -> np.ndarray:
    """Parity bits of a set, about as many as it has tokens, as bytes; see :func:`parity`."""
    bits = max(64, 1 << (len(tokens) - 1).bit_length()) if len(tokens) else 64
    odd = np.bincount(((tokens >> np.uint64(17)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def unlike_bits(a: np.ndarray, b: np.ndarray) -> int:
    """In how many places the scaled bits of two sets differ, the longer ones folded."""
    if len(a) > len(b):
        a, b = b, a
    folded = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.unpackbits(a ^ folded).sum())


def set_rows(docs: DataFrame, width: int, least: Threshold) -> DataFrame:
    """Per row ``doc_id``, ``n`` (set size), ``node``, which stands for the set and is NULL for an
    empty one, the set's prefixes under two orders and its parity bits, from one read of the texts: few in columns,
    and ``bits``, as many as the set has tokens."""
    often, times = repeating_tokens(docs, width)

    def first_tokens(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = least.prefix(len(tokens))
        other = mixed(tokens ^ np.uint64(OTHER_ORDERS[0]))
        rank = np.zeros(len(tokens), np.int64)
        if len(often):
            at = np.searchsorted(often, tokens)
            at[at == len(often)] = 0
            rank = np.where(often[at] == tokens, times[at], 0)
        if rank.any():
            return tokens[np.lexsort((tokens, rank))[:count]], tokens[np.lexsort((other, rank))[:count]]
        second = np.argpartition(other, count - 1)[:count] if count < len(other) else slice(None)
        return tokens[:count], tokens[second]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), width)
            firsts = [first_tokens(s) if len(s) else (none, none) for s in sets]
            bits = np.array([parity(s) for s in sets], np.int64).reshape(len(sets), PARITY_WORDS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64()),
                    _lists([a for a, _ in firsts]),
                    _lists([b for _, b in firsts]),
                    pa.array([scaled_parity(s).tobytes() for s in sets], pa.binary()),
                    *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(PARITY_WORDS)],
                ],
                names=["doc_id", "n", "node", "prefix", "second", "bits", *PARITY],
            )

    schema = "doc_id bigint, n bigint, node bigint, prefix array<bigint>, second array<bigint>, bits binary"
    return docs.select("doc_id", "text").mapInArrow(
        describe, ", ".join([schema, *[f"{p} bigint" for p in PARITY]])
    )


def _lists(arrays: Sequence[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.uint64), *arrays])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def token_groups(nodes: DataFrame, prefix: str) -> DataFrame:
    """``token``, ``id``, ``n``, and of the token's group its size ``g`` and tokens ``total``;
    groups of one are left out."""
    tokens = nodes.select(F.explode(prefix).alias("token"), "id", "n")
    groups = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("g"), F.sum("n").alias("total"))
    return tokens.join(groups.where("g > 1"), "token").select("token", "id", "n", "g", "total")


def small_group_pairs(shared: DataFrame, parities: DataFrame, least: Threshold) -> DataFrame:
    """Distinct pairs ``u < v`` that share a small group and whose sizes and parity bits allow a
    link. Most pairs that only share a passage are out before they leave the task that meets them."""
    small = shared.where(F.col("g") <= SMALL_GROUP).select("token", "id", "n").join(parities, "id")
    renamed = {"id": "v", "n": "m"} | {p: f"other_{p}" for p in PARITY}
    other = small.withColumnsRenamed(renamed)
    unlike = " + ".join(f"bit_count({p} ^ other_{p})" for p in PARITY)
    few = f"({unlike}) * {least.den + least.num}L <= {least.den - least.num}L * (n + m)"
    fits = (F.col("u") < F.col("v")) & least.sizes_fit(F.col("n"), F.col("m")) & F.expr(few)
    mine = small.withColumnRenamed("id", "u")
    return mine.join(other, "token").where(fits).select("u", "v").distinct()


def packed(tokens: np.ndarray) -> bytes:
    """Six bytes of each token: two of a pair's tokens are mistaken with a chance of 2**-48."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    six = np.frombuffer(data, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return np.sort(out.view("<u8").ravel())


def node_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The rows of ``wanted`` (``id``, ``node``, ``stands`` and more) with ``tokens``, their sets.

    Texts are scanned where they lie, against a bit filter of the wanted nodes; sets of others
    that slip through meet no wanted row. Rows repeated in the table give repeated rows.
    """
    filled = filter_bits(wanted.select(F.col("node").alias("key")))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), width)
            real = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
            nodes = np.array([fingerprint(sets[i]) for i in real], np.int64)
            hit = passes(nodes.view(np.uint64), filled)
            kept = real[hit]
            columns = [
                batch.column("doc_id").take(pa.array(kept)),
                pa.array(nodes[hit]),
                pa.array([packed(sets[i]) for i in kept], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "of", "tokens"])

    made = docs.select("doc_id", "text").mapInArrow(
        rows, "doc_id bigint, of bigint, tokens binary"
    )
    # Of equal sets only the standing row's moves on.
    same = (F.col("of") == F.col("node")) & F.col("doc_id").eqNullSafe(F.col("stands"))
    return made.join(wanted, same).select(*wanted.columns, "tokens")


def _sets(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    return [unpacked(x) for x in column.to_pylist()]


def cluster_links(pairs: DataFrame, sets: DataFrame, least: Threshold) -> DataFrame:
    """The linked ones among pairs ``cluster``, ``u``, ``v``; ``sets`` has ``cluster``, ``id``,
    ``tokens``. A set is sent once, to its cluster, whose size the caller has bounded."""

    def check(listed: pa.Table, held: pa.Table) -> pa.Table:
        tokens = dict(zip(held.column("id").to_pylist(), _sets(held.column("tokens"))))
        links = []
        for u, v in zip(listed.column("u").to_pylist(), listed.column("v").to_pylist()):
            a, b = tokens[u], tokens[v]
            if _candidate(a, b, least) and least.linked(a, b):
                links.append((u, v))
        u, v = zip(*links) if links else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    grouped = pairs.groupBy("cluster").cogroup(sets.groupBy("of_cluster"))
    return grouped.applyInArrow(check, "u bigint, v bigint")


def verified_pairs(pairs: DataFrame, sets: DataFrame, least: Threshold) -> DataFrame:
    """The linked ones among pairs ``u``, ``v``: other orders' prefixes first, then whole sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = zip(_sets(batch.column("a")), _sets(batch.column("b")))
            linked = [_candidate(a, b, least) and least.linked(a, b) for a, b in held]
            yield batch.select(["u", "v"]).filter(pa.array(linked, pa.bool_()))

    a = sets.select(F.col("id").alias("u"), F.col("tokens").alias("a"))
    b = sets.select(F.col("id").alias("v"), F.col("tokens").alias("b"))
    return pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(
        check, "u bigint, v bigint"
    )


def alike_pairs(pairs: DataFrame, nodes: DataFrame, least: Threshold) -> DataFrame:
    """Pairs ``u``, ``v`` whose parity bits, as many as the sets have tokens, allow a link.

    Bits are an eighth of a byte a token, so that whole sets are sent for the few pairs left only.
    """

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([np.frombuffer(x, np.uint8) for x in batch.column(c).to_pylist()] for c in ("a", "b"))
            unlike = np.array([unlike_bits(x, y) for x, y in zip(a, b)], np.int64)
            sizes = batch.column("n").to_numpy() + batch.column("m").to_numpy()
            kept = unlike * (least.den + least.num) <= (least.den - least.num) * sizes
            yield batch.select(["u", "v"]).filter(pa.array(kept, pa.bool_()))

    of_u = nodes.select(F.col("id").alias("u"), "n", F.col("bits").alias("a"))
    of_v = nodes.select(F.col("id").alias("v"), F.col("n").alias("m"), F.col("bits").alias("b"))
    return pairs.join(of_u, "u").join(of_v, "v").mapInArrow(agree, "u bigint, v bigint")


def alike_forest(
    sizes: np.ndarray, sides: np.ndarray, bits: Sequence[bytes], within: bool, least: Threshold
) -> list[tuple[int, int]]:
    """Places of pairs that connect all whose sizes and parity bits allow a link.

    By rising size, a set is held against those that are larger by no more than a link allows; the
    bits of these are as many or more, and are folded. ``within``: all pairs count; else only those
    across ``sides``.
    """
    by_size = np.argsort(sizes, kind="stable")
    sizes, sides = sizes[by_size], sides[by_size]
    widths = np.array([len(b) for b in bits])[by_size]
    last = np.searchsorted(sizes, least.den * sizes // least.num, side="right")
    label = np.arange(len(sizes))
    edges = []
    for width in np.unique(widths).tolist():
        a, b = np.searchsorted(widths, [width, width + 1]).tolist()
        rows = [np.frombuffer(bits[k], "<u8").reshape(-1, width // 8) for k in by_size[a : last[b - 1]]]
        folded = np.stack([r[0] if len(r) == 1 else np.bitwise_xor.reduce(r, axis=0) for r in rows])
        for i in range(a, b):
            open_ = label[i + 1 : last[i]] != label[i]
            if not within:
                open_ &= sides[i + 1 : last[i]] != sides[i]
            at = i + 1 + np.flatnonzero(open_)
            if not len(at):
                continue
            unlike = np.bitwise_count(folded[at - a] ^ folded[i - a]).sum(axis=1, dtype=np.int64)
            alike = unlike * (least.den + least.num) <= (least.den - least.num) * (sizes[i] + sizes[at])
            joined, first = np.unique(label[at[alike]], return_index=True)
            edges += [(int(by_size[i]), int(by_size[j])) for j in at[alike][first]]
            if len(joined):
                label[np.isin(label, joined)] = label[i]
    return edges


def alike_clusters(rows: DataFrame, nodes: DataFrame, least: Threshold) -> DataFrame:
    """``id`` and ``component`` of the nodes that have a partner in a large token group whose parity
    bits allow a link; all linked pairs of these groups are within a component.

    ``rows``: token, id, n, group size ``g`` and tokens in the group (``total``). Bits alone are sent
    to the blocks of each group, and each pair of blocks returns the edges of a forest.
    """
    spark = rows.sparkSession
    blocks = F.ceil(F.greatest(F.col("g") / ALIKE_BLOCK, F.col("total") / (ALIKE_TOKENS * BLOCK_TOKENS)))
    dealt = rows.select("token", "id", "n", blocks.cast("int").alias("blocks")).withColumn(
        "block", F.pmod(F.xxhash64("id", "token"), "blocks").cast("int")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = dealt.select(
        "token", "id", "n", "block",
        F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
    )

    def compare(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_pylist()
        found = alike_forest(
            table.column("n").to_numpy(),
            table.column("block").to_numpy(),
            table.column("bits").to_pylist(),
            table.column("first")[0].as_py() == table.column("second")[0].as_py(),
            least,
        )
        u, v = [ids[i] for i, _ in found], [ids[j] for _, j in found]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    full = tasks.join(nodes.select("id", "bits"), "id")
    edges = full.groupBy("token", "first", "second").applyInArrow(compare, "u bigint, v bigint")
    return connected_components(edges).withColumnRenamed("node", "id")


def connecting_links(pairs: DataFrame, sets: DataFrame, least: Threshold) -> list[str]:
    """Linked pairs that connect all that the linked ones among ``pairs`` (written) connect, as paths
    of tables ``u``, ``v``.

    Each round compares every node with the least of its partners left, so that a set is sent about
    twice; pairs that links connect already are not compared. After ``PICKING_ROUNDS`` all others are.
    """
    spark = pairs.sparkSession
    found: list[str] = []
    schema = "u bigint, v bigint"
    for nth in range(PICKING_ROUNDS + 1):
        tried = pairs
        if nth < PICKING_ROUNDS:
            tried = pairs.groupBy("v").agg(F.min("u").alias("u")).select("u", "v")
        found.append(scratch_path(spark, "shingle-links"))
        written(verified_pairs(tried, sets, least), found[-1], tidy=True)
        if nth == PICKING_ROUNDS:
            break
        known = connected_components(spark.read.schema(schema).parquet(*found))
        of_u, of_v = known.toDF("u", "of_u"), known.toDF("v", "of_v")
        open_ = pairs.join(tried, ["u", "v"], "left_anti").join(of_u, "u", "left").join(of_v, "v", "left")
        apart_ = open_.where("NOT coalesce(of_u = of_v, false)").select("u", "v")
        pairs = written(apart_, scratch_path(spark, "shingle-open"), tidy=True)
        if pairs.isEmpty():
            break
    return found


def _candidate(a: np.ndarray, b: np.ndarray, least: Threshold) -> bool:
    if not least.sizes_fit(len(a), len(b)):
        return False
    for salt in OTHER_ORDERS:
        if not _share(_first(a, least.prefix(len(a)), salt), _first(b, least.prefix(len(b)), salt)):
            return False
    return True


def block_links(
    nodes: Sequence[int], sides: np.ndarray, sets: Sequence[np.ndarray],
    groups: Sequence[np.ndarray], token: int | None, within: bool, least: Threshold,
) -> list[tuple[int, int]]:
    """Links that connect what two blocks of a token's group, or of a cluster, hold.

    ``groups`` are the tokens of large groups that each node is in. In a token's group, a pair is
    left to the least token it shares; in a cluster (no ``token``) it must share one. ``within``: the blocks are one, and all its pairs count; else only
    pairs across count.
    """
    n = len(nodes)
    sizes = np.array([len(s) for s in sets])
    members: dict[int, list[int]] = {}
    for i, listed in enumerate(groups):
        for t in (listed if token is None else listed[listed < token]).tolist():
            members.setdefault(t, []).append(i)
    orders = []
    for salt in OTHER_ORDERS:
        holders: dict[int, list[int]] = {}
        firsts = [_first(s, least.prefix(len(s)), salt).tolist() for s in sets]
        for i, first in enumerate(firsts):
            for t in first:
                holders.setdefault(t, []).append(i)
        orders.append((firsts, holders))
    label = np.arange(n)
    links = []
    for i in range(n - 1):
        open_ = label != label[i]
        open_[: i + 1] = False
        if not within:
            open_ &= sides != sides[i]
        open_ &= least.sizes_fit(sizes[i], sizes)
        if token is None:
            shared = np.zeros(n, bool)
            for t in groups[i].tolist():
                shared[members[t]] = True
            open_ &= shared
        else:
            for t in groups[i][groups[i] < token].tolist():
                open_[members[t]] = False
        for firsts, holders in orders:
            if not open_.any():
                break
            sharing = np.zeros(n, bool)
            for t in firsts[i]:
                sharing[holders[t]] = True
            open_ &= sharing
        for j in np.flatnonzero(open_).tolist():
            if label[j] != label[i] and least.linked(sets[i], sets[j]):
                links.append((nodes[i], nodes[j]))
                label[label == label[j]] = label[i]
    return links


def large_group_links(
    rows: DataFrame, clusters: DataFrame, sets: DataFrame, least: Threshold
) -> DataFrame:
    """Links within large token groups; ``rows``: token, id, n; ``clusters``: id, component.

    Nodes of one component (:func:`alike_clusters`) are compared as one cluster, so that a set is
    sent once per block and not once per token, unless the cluster has more than ``CLUSTER_BLOCKS``
    blocks; then what it holds of each token's group is compared by itself.
    """
    spark = rows.sparkSession
    listed = rows.groupBy("id").agg(F.collect_list("token").alias("groups"), F.first("n").alias("n"))
    sized = clusters.join(listed.select("id", "n"), "id").groupBy("component").agg(
        F.sum("n").alias("cluster_total")
    )
    known = written(clusters.join(sized, "component"), scratch_path(spark, "shingle-crowds"), tidy=True)
    together = F.col("cluster_total") <= CLUSTER_BLOCKS * BLOCK_TOKENS
    by_cluster = known.where(together).select(
        F.lit(None).cast("bigint").alias("token"), F.col("component").alias("cluster"), "id",
        F.col("cluster_total").alias("total"),
    )
    alone = rows.join(known.where(~together).select("id", F.col("component").alias("cluster")), "id")
    totals = alone.groupBy("token", "cluster").agg(F.sum("n").alias("total"))
    by_token = alone.join(totals, ["token", "cluster"]).select("token", "cluster", "id", "total")
    keyed = by_cluster.unionByName(by_token)
    blocks = F.ceil(F.col("total") / BLOCK_TOKENS).cast("int")
    # Salted by group, so that groups do not split alike.
    block = F.pmod(F.xxhash64("id", "token", "cluster"), blocks).cast("int")
    dealt = keyed.select(
        "token", "cluster", "id", blocks.alias("blocks"), block.alias("block")
    ).select(
        "token", "cluster", "id", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    tasks = dealt.select(
        "token", "cluster", "id", "block",
        F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("id").combine_chunks()
        tokens = [np.array(x.values.to_numpy(), np.int64) for x in table.column("groups")]
        links = block_links(
            table.column("id").to_pylist(),
            table.column("block").to_numpy(),
            _sets(table.column("tokens")),
            tokens,
            table.column("token")[0].as_py(),
            table.column("first")[0].as_py() == table.column("second")[0].as_py(),
            least,
        )
        u, v = zip(*links) if links else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    full = tasks.join(listed.select("id", "groups"), "id").join(sets, "id")
    return full.groupBy("token", "cluster", "first", "second").applyInArrow(compare, "u bigint, v bigint")


def linked_nodes(
    docs: DataFrame, num: int, den: int, width: int
) -> tuple[DataFrame, DataFrame]:
    """Rows as ``doc_id``, ``n``, ``node``, and nodes as ``node``, ``component``, ``stands`` (the
    least id of the node's rows)."""
    spark = docs.sparkSession
    least = Threshold(num, den)
    used: dict[str, str] = {}

    def kept(df: DataFrame, name: str) -> DataFrame:
        """The table as written; the write's shuffle files go."""
        used[name] = scratch_path(spark, f"shingle-{name}")
        return written(df, used[name], tidy=True)

    def gone(*names: str) -> None:
        """These tables, which nothing reads any more, go."""
        for name in names:
            discard(spark, used.pop(name))

    described = kept(set_rows(docs, width, least), "rows")
    heavy = ("n", "prefix", "second", "bits", *PARITY)
    nodes = described.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("stands"), *[F.first(c).alias(c) for c in heavy]
    )
    # Numbered as they are written, so that later tables hold short ids.
    nodes = kept(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    rows = kept(described.select("doc_id", "n", "node"), "ids")
    gone("rows")
    members = kept(nodes.select("id", "node", "stands", "n"), "members")
    first = kept(token_groups(nodes, "prefix"), "first")
    second = kept(token_groups(nodes, "second"), "second")
    nodes = kept(nodes.select("id", "n", "bits", *PARITY), "parities")
    gone("nodes")
    parities = nodes.select("id", *PARITY)
    # Candidates under the first order that are candidates under the second, too: in a small group,
    # or perhaps in a large one, if both are in some.
    pairs = kept(small_group_pairs(first, parities, least), "pairs")
    agreed = pairs.join(small_group_pairs(second, parities, least), ["u", "v"], "left_semi")
    crowd = second.where(F.col("g") > SMALL_GROUP).select("id").distinct()
    crowded = pairs.join(crowd.select(F.col("id").alias("u")), "u", "left_semi").join(
        crowd.select(F.col("id").alias("v")), "v", "left_semi"
    )
    pairs = kept(alike_pairs(agreed.unionByName(crowded).distinct(), nodes, least), "candidates")
    gone("second", "pairs")
    large = first.where(F.col("g") > SMALL_GROUP)
    crowds = kept(alike_clusters(large, nodes, least), "crowds")
    large = kept(large.join(crowds, "id", "left_semi").select("token", "id", "n"), "large")
    gone("first", "parities")
    # Candidates hang together in clusters. A small one is compared in one task, to which each set
    # is sent once; pairs of a large one and large token groups take their sets pair by pair.
    clusters = connected_components(pairs)
    placed = members.join(
        clusters.select(F.col("node").alias("id"), F.col("component").alias("cluster")), "id"
    )
    sizes = placed.groupBy("cluster").agg((F.sum("n") <= BLOCK_TOKENS).alias("small"))
    placed = kept(placed.join(sizes, "cluster").select("id", "cluster", "small"), "clusters")
    far_ids = placed.where("NOT small").select("id").union(crowds.select("id")).distinct()
    homes = placed.where("small").select("id", F.col("cluster").alias("of_cluster"))
    wanted = homes.join(far_ids.withColumn("far", F.lit(True)), "id", "full")
    wanted = kept(members.drop("n").join(wanted, "id"), "wanted")
    # The texts are read a third and last time for the sets that are still wanted.
    sets = kept(node_sets(docs, wanted, width).select("of_cluster", "far", "id", "tokens"), "sets")
    near = pairs.join(homes.select(F.col("id").alias("u"), F.col("of_cluster").alias("cluster")), "u")
    held = sets.where("of_cluster IS NOT NULL").select("of_cluster", "id", "tokens")
    links = kept(cluster_links(near.select("cluster", "u", "v"), held, least), "links")
    if not wanted.where("far").isEmpty():
        far_sets = kept(sets.where("far").select("id", "tokens").dropDuplicates(["id"]), "far-sets")
        gone("sets")
        far = pairs.join(placed.where("NOT small").select(F.col("id").alias("u")), "u", "left_semi")
        found = connecting_links(kept(far, "far"), far_sets, least)
        links = links.union(spark.read.schema(links.schema).parquet(*found))
        links = links.union(kept(large_group_links(large, crowds, far_sets, least), "large-links"))
        used.update((path, path) for path in found)
    joined = connected_components(links).withColumnRenamed("node", "id")
    gone(*(name for name in list(used) if name not in ("ids", "members")))
    component = F.coalesce("component", "id").alias("component")
    by_node = members.join(joined, "id", "left").select("node", component, "stands")
    return rows, by_node


def jaccard_components(
    docs: DataFrame, num: int = 90, den: int = 100, width: int = 3
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased. Rows link when
    ``den * intersection >= num * union``; ``component_id`` is the least ``doc_id`` that links
    lead to. Equal sets link, whatever their number; an empty or NULL text has no shingle and is
    linked with nothing. NULL ids are compared like others and are a component's id only if it has
    no other. An empty table gives no rows; further columns are not used. A text of any length is
    one set, made by itself if it is long, in memory that grows with its words. Tokens and sets are
    held as 64-bit hashes.
    """
    rows, by_node = linked_nodes(docs, num, den, width)
    least_ids = by_node.groupBy("component").agg(F.min("stands").alias("component_id"))
    named = by_node.join(least_ids, "component").select("node", "component_id")
    return rows.join(named, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"),
    )


def one_per_component(
    docs: DataFrame, num: int = 90, den: int = 100, width: int = 3
) -> DataFrame:
    """The document with the least id of each component, all columns as they are.

    Documents without shingles are in no component and stay. Of rows equal in id and shingles one
    stays; NULL ids stay only where a component has no other. Columns may have any names.
    """
    spark = docs.sparkSession
    rows, by_node = linked_nodes(docs, num, den, width)
    by_node = written(by_node, scratch_path(spark, "shingle-components"))
    named = apart(docs, "doc_id", "text")
    order = F.struct(F.col("stands").isNull(), "stands", "node")
    chosen = by_node.groupBy("component").agg(F.min(order).alias("c"))
    kept = chosen.groupBy(F.col("c.stands").alias("_stands")).agg(F.collect_set("c.node").alias("_nodes"))
    found = named.join(kept, F.col("doc_id").eqNullSafe(F.col("_stands")), "left").drop("_stands")
    names = named.columns

    def stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), width)
            nodes = [fingerprint(x) if len(x) else None for x in sets]
            listed = batch.column("_nodes").to_pylist()
            keep = [n is None or n in (held or ()) for n, held in zip(nodes, listed)]
            out = batch.select(names).append_column("_node", pa.array(nodes, pa.int64()))
            yield out.filter(pa.array(keep, pa.bool_()))

    schema = T.StructType([*named.schema.fields, T.StructField("_node", T.LongType())])
    stayed = found.mapInArrow(stay, schema)
    # Rows equal in id and shingles are rare; only where there are any is one picked.
    if rows.where("node IS NOT NULL").groupBy("doc_id", "node").count().where("count > 1").isEmpty():
        return together(stayed.drop("_node"), docs)
    empty = stayed.where("_node IS NULL")
    single = stayed.where("_node IS NOT NULL").dropDuplicates(["doc_id", "_node"])
    return together(empty.union(single).drop("_node"), docs)
