"""Prefix trie of conversations: double arrays for each prefix shard, shared nodes merged globally.

A node is a sequence of first turns; it is named by its depth and the exclusive or of a 128-bit hash
of each turn at its place, so that the name of a prefix follows from the name of a shorter one.

1. Conversations are cut into layers of ``LAYER`` turns. Equal stretches after equal prefixes become
   one row with the number of their conversations and the least of them.
2. These rows are sorted by prefix and turns and dealt out by ranges; a shard is a run of them of
   ``SHARD_TURNS`` turns. So one first turn, or one opening, of a third of all conversations is spread
   over many shards.
3. A shard gives its turns dense ids and packs BASE and CHECK: from state s, turn t leads to
   ``BASE[s] + t`` if ``CHECK`` there is s. All rows are walked through the arrays together, place by
   place; what arrives at a state is counted there.
4. A shard knows all of a node but where a neighbouring shard or the next layer has a part of it, and
   those nodes lie on the ways to its first row, its last row, and rows that go on in the next layer.
   They, the upper nodes, are merged by name. Sums over their subtrees go up the merged tree by
   pointer doubling, in rounds that grow with the logarithm of the depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytrace.llm.common import column, small_batches, stored

#: Turns of a conversation that are kept together.
LAYER = 1024
#: Turns after which a shard is closed.
SHARD_TURNS = 1 << 16
#: Upper nodes up to this number are broadcast to look up parents (40 bytes each).
FEW_NODES = 100_000
#: Conversation ids that are joined to one text before their digest is taken.
IDS_TOGETHER = 4096
_NODE = ["depth", "p0", "p1"]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns_of(
    conversations: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """``turns(conv, place, h0, h1, size)`` and ``convs(conv, n)`` of a conversation table.

    Turns are placed from 0 in the order of ``turn``, NULL first; equal ones by role, then text, so
    that repeated rows are turns of their own. NULL roles and texts are empty. Rows without a
    conversation id take no part. Roles and texts are told apart by 128 bits.

    Turns are dealt out in ranges, and a conversation may reach over several; so a row for each
    conversation and range tells where its stretch begins.
    """
    rows = conversations.select(
        column(conversations, conv_col).cast("bigint").alias("conv"),
        column(conversations, turn_col).alias("turn"),
        F.coalesce(column(conversations, role_col), F.lit("")).alias("role"),
        F.coalesce(column(conversations, text_col), F.lit("")).alias("text"),
    ).filter(F.col("conv").isNotNull())
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    ranged = stored(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv",
            F.xxhash64("role", "text").alias("h0"),
            F.xxhash64(F.lit("second"), "role", "text").alias("h1"),
            F.octet_length("text").cast("bigint").alias("size"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "trie-turns",
    ).withColumn("range", F.shiftright("at", 33))
    spans = stored(
        ranged.groupBy("conv", "range").agg(F.min("at").alias("first"), F.count("*").alias("n")),
        "trie-spans",
    )
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begin = spans.select(
        "conv", "range", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift")
    )
    turns = ranged.join(begin, ["conv", "range"]).select(
        "conv", (F.col("at") + F.col("shift")).alias("place"), "h0", "h1", "size"
    )
    return turns, spans.groupBy("conv").agg(F.sum("n").alias("n"))


def with_shared_openings(
    turns: DataFrame, convs: DataFrame, *, every: int = 5, longest: int = 9
) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt so that some share their opening; same columns as the arguments.

    Conversation c takes its first h turns from conversation ``c - c % every`` (all if that has
    fewer, none if it is absent) and goes on with its own turns after its first h; h is the crc32 of
    c in decimals modulo ``longest``. A conversation may be left without turns (n is 0).
    """
    base = F.col("conv") - F.col("conv") % every
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % longest
    known = convs.withColumns({"base": base, "h": taken})
    sizes = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    plan = stored(
        known.join(sizes, "base", "left").select(
            "conv",
            "base",
            "n",
            F.when(F.col("base") == F.col("conv"), 0).otherwise(F.col("h")).alias("skip"),
            F.when(F.col("base") == F.col("conv"), 0)
            .otherwise(F.least("h", F.coalesce("n_base", F.lit(0))))
            .alias("lead"),
        ),
        "trie-plan",
    )
    own = (
        turns.join(plan.select("conv", "skip", "lead"), "conv")
        .filter("place >= skip")
        .withColumn("place", F.col("place") - F.col("skip") + F.col("lead"))
    )
    steps = F.array(*[F.lit(i) for i in range(1 - every, every) if i])
    borrowed = (
        turns.filter((F.col("conv") % every == 0) & (F.col("place") < longest - 1))
        .withColumnRenamed("conv", "base")
        .withColumn("step", F.explode(steps))
        .withColumn("conv", F.try_add("base", F.col("step").cast("bigint")))
        .join(plan.select("conv", F.col("base").alias("own_base"), "lead"), "conv")
        .filter("own_base = base AND place < lead")
    )
    names = ["conv", "place", "h0", "h1", "size"]
    left = F.greatest(F.col("n") - F.col("skip"), F.lit(0)) + F.col("lead")
    return own.select(*names).unionByName(borrowed.select(*names)), plan.select("conv", left.alias("n"))


def _stretches(turns: DataFrame, convs: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """``(classes, ends)``: equal stretches of turns after equal prefixes, and where conversations end."""
    terms = [F.xxhash64(F.lit(i), "place", "h0", "h1") for i in (0, 1)]
    layer = F.floor(F.col("place") / size).cast("int")
    grouped = turns.select("conv", "place", layer.alias("layer"), terms[0].alias("t0"), terms[1].alias("t1"), "size")
    turn = F.struct("place", "t0", "t1", "size")
    parts = stored(
        grouped.groupBy("conv", "layer").agg(  # so many turns at most
            F.transform(
                F.sort_array(F.collect_list(turn)), lambda x: F.struct(x["t0"], x["t1"], x["size"])
            ).alias("turns"),
            F.bit_xor("t0").alias("x0"),
            F.bit_xor("t1").alias("x1"),
        ),
        "trie-stretches",
    )
    slim = parts.select("conv", "layer", "x0", "x1")
    order = Window.partitionBy("conv").orderBy("layer")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    prefixes = slim.select(
        "conv",
        "layer",
        *[F.coalesce(F.bit_xor(f"x{i}").over(earlier), F.lit(0)).alias(f"p{i}") for i in (0, 1)],
        F.lead("layer").over(order).isNotNull().alias("more"),
    )
    silent = convs.filter("n = 0").select(
        "conv",
        F.lit(0).alias("layer"),
        F.expr("CAST(array() AS array<struct<t0: bigint, t1: bigint, size: bigint>>)").alias("turns"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("x0", "x1", "p0", "p1")],
        F.lit(False).alias("more"),
    )
    whole = parts.join(prefixes, ["conv", "layer"]).unionByName(silent)
    classes = whole.groupBy("layer", "p0", "p1", "x0", "x1", F.size("turns").alias("n_turns")).agg(
        F.first("turns").alias("turns"),
        F.count("*").alias("n"),
        F.min("conv").alias("conv"),
        F.bool_or("more").alias("more"),
    )
    ends = whole.groupBy("conv").agg(
        F.sum(F.size("turns")).alias("depth"),
        F.bit_xor("x0").alias("p0"),
        F.bit_xor("x1").alias("p1"),
    )
    return classes.drop("x0", "x1", "n_turns"), ends


class DoubleArray:
    """BASE and CHECK over states; the first states are roots. Free slots have CHECK -1."""

    def __init__(self, roots: int):
        self.base = np.zeros(max(16, 2 * roots), np.int64)
        self.check = np.full(len(self.base), -1, np.int64)
        self.check[:roots] = -2
        self.high = self.low = roots

    def _room(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def add(self, parents: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """Pack children, sorted by parent and all children of each parent; their states."""
        first = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        count = np.diff(np.append(first, len(parents)))
        for at, n in zip(first[count > 1].tolist(), count[count > 1].tolist(), strict=True):
            self._several(int(parents[at]), np.sort(turns[at : at + n]))
        alone = first[count == 1]
        self._room(self.high + len(alone))
        free = np.flatnonzero(self.check[self.low : self.high + len(alone)] == -1)[: len(alone)] + self.low
        self.base[parents[alone]] = free - turns[alone]
        self.check[free] = parents[alone]
        if len(free):
            self.low, self.high = int(free[-1]) + 1, max(self.high, int(free[-1]) + 1)
        return self.base[parents] + turns

    def _several(self, parent: int, turns: np.ndarray) -> None:
        shape = turns - turns[0]
        start = self.high
        self._room(self.high + int(shape[-1]) + 1)
        if len(turns) <= 64:  # else behind all others: holes are filled by single children
            holes = np.flatnonzero(self.check[self.low : self.low + 4096] == -1)[:512] + self.low
            holes = holes[holes + shape[-1] < len(self.check)]
            fits = (self.check[holes[:, None] + shape] == -1).all(1)
            if fits.any():
                start = int(holes[fits.argmax()])
        self.base[parent] = start - turns[0]
        self.check[start + shape] = parent
        self.high = max(self.high, start + int(shape[-1]) + 1)

    def step(self, states: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """Where turns lead from states; every step of a packed sequence is there."""
        arrived = self.base[states] + turns
        if not (self.check[arrived] == states).all():
            raise AssertionError("a turn leads nowhere")
        return arrived


def _dense(pairs: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ids 0, 1, ... of the rows of ``pairs`` by where each first comes in ``order``.

    So turns that first come after one another, such as those of one parent, have close ids.
    """
    by_value = np.lexsort((order, pairs[:, 1], pairs[:, 0]))
    ordered = pairs[by_value]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(1)])
    group = np.cumsum(new) - 1
    rank = np.empty(new.sum(), np.int64)
    rank[np.argsort(order[by_value[new]])] = np.arange(len(rank))
    ids = np.empty(len(pairs), np.int64)
    ids[by_value] = rank[group]
    return ids


_ROW = (
    "depth bigint, p0 bigint, p1 bigint, q0 bigint, q1 bigint, conv bigint, parent bigint, n bigint, "
    "size bigint, children bigint, leaves bigint, saved bigint, upper boolean, below boolean"
)
_NAMES = [x.split()[0] for x in _ROW.split(", ")]
_TYPES = [pa.int64()] * 12 + [pa.bool_()] * 2


def _shard_nodes(first, p0, p1, lengths, turns, n, conv, more) -> list[np.ndarray]:
    """Columns of ``_ROW`` for the nodes of a shard; arguments by row, ``turns`` as three columns.

    ``first`` is the depth at which a row's layer begins.

    ``upper`` marks nodes that other shards or layers may have a part of; their sums hold what lies
    below nodes that are not upper. ``below`` marks the others right below an upper node.
    """
    total, deepest = int(lengths.sum()), int(lengths.max(initial=0))
    begin = np.cumsum(lengths) - lengths
    row_of = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(total) - begin[row_of]
    order = np.empty(total, np.int64)
    order[np.lexsort((row_of, place))] = np.arange(total)
    ids = _dense(turns[:, :2], order) if total else order
    head = np.stack([first, p0, p1], 1)
    new_root = np.concatenate([[True], (head[1:] != head[:-1]).any(1)])
    root = np.cumsum(new_root) - 1

    # BASE and CHECK, place by place; rows are sorted, so equal beginnings lie together.
    trie, state = DoubleArray(int(root[-1]) + 1), root.copy()
    for d in range(deepest):
        on = np.flatnonzero(lengths > d)
        own, turn = state[on], ids[begin[on] + d]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (turn[1:] != turn[:-1])])
        state[on] = trie.add(own[new], turn[new])[np.cumsum(new) - 1]

    # The walk: all rows together from their roots, counting at each state they arrive at.
    size = trie.high
    depth, count, least, last = (np.zeros(size, np.int64) for _ in range(4))
    name, upper = np.zeros((size, 2), np.int64), np.zeros(size, bool)
    least[:] = np.iinfo(np.int64).max
    state = root.copy()
    depth[state], name[state, 0], name[state, 1] = first, p0, p1
    upper[state] = True
    np.add.at(count, state, n)
    np.minimum.at(least, state, conv)
    edge = more.copy()
    edge[[0, -1]] = True
    levels = [np.unique(state)]
    for d in range(deepest):
        on = np.flatnonzero(lengths > d)
        own, at = state[on], begin[on] + d
        arrived = trie.step(own, ids[at])
        depth[arrived] = depth[own] + 1
        name[arrived] = name[own] ^ turns[at, :2]
        last[arrived] = turns[at, 2]
        upper[arrived[edge[on]]] = True
        np.add.at(count, arrived, n[on])
        np.minimum.at(least, arrived, conv[on])
        state[on] = arrived
        levels.append(np.unique(arrived))

    # Subtree sums, from the deepest level up; what hangs on an upper node is merged later.
    children, leaves, saved = (np.zeros(size, np.int64) for _ in range(3))
    for nodes in reversed(levels[1:]):
        inner = nodes[~upper[nodes]]
        leaves[inner] += children[inner] == 0
        saved[inner] += (count[inner] - 1) * last[inner]
        up = trie.check[inner]
        np.add.at(children, up, 1)
        np.add.at(leaves, up, leaves[inner])
        np.add.at(saved, up, saved[inner])
    nodes = np.concatenate(levels)
    parent = trie.check[nodes]
    is_root = parent < 0
    up = np.where(is_root, nodes, parent)
    # The root of a later layer is counted by the layer above.
    above = is_root & (depth[nodes] > 0)
    columns = [depth[nodes], name[nodes, 0], name[nodes, 1], name[up, 0], name[up, 1]]
    columns += [least[nodes], least[up], np.where(above, 0, count[nodes]), last[nodes]]
    columns += [children[nodes], leaves[nodes], saved[nodes], upper[nodes], ~upper[nodes] & upper[up]]
    masks = {3: is_root, 4: is_root, 5: above, 6: is_root}
    return [pa.array(c, t, mask=masks.get(i)) for i, (c, t) in enumerate(zip(columns, _TYPES, strict=True))]


def _nodes(shard_turns: int, layer_turns: int):
    """mapInArrow function from sorted classes to the nodes of their shards."""

    def shard(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        plain = [np.asarray(rows.column(c)) for c in ("layer", "p0", "p1")]
        lists = rows.column("turns").chunk(0) if rows.num_rows else None
        values = lists.flatten()
        turns = np.stack([np.asarray(x, np.int64) for x in values.flatten()], 1)
        lengths = np.asarray(lists.value_lengths(), np.int64)
        more = rows.column("more").to_numpy().astype(bool)
        n, conv = (np.asarray(rows.column(c)) for c in ("n", "conv"))
        return pa.RecordBatch.from_arrays(
            _shard_nodes(plain[0].astype(np.int64) * layer_turns, plain[1], plain[2], lengths, turns, n, conv, more),
            _NAMES,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            at = 0
            sizes = np.asarray(batch.column("turns").value_lengths(), np.int64)
            for i in range(len(batch)):
                size += int(sizes[i])
                if size >= shard_turns:
                    waiting.append(batch.slice(at, i + 1 - at))
                    yield shard(pa.Table.from_batches(waiting))
                    waiting, size, at = [], 0, i + 1
            if at < len(batch):
                waiting.append(batch.slice(at))
        if waiting:
            yield shard(pa.Table.from_batches(waiting))

    return run


def _merged(upper: DataFrame) -> DataFrame:
    """Upper nodes by name, with all their children and the sums over their whole subtrees."""
    merged = stored(
        upper.groupBy(*_NODE).agg(
            *[F.max(c).alias(c) for c in ("q0", "q1", "size")],
            F.min("conv").alias("conv"),
            *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")],
        ),
        "trie-upper",
    )
    below = (
        merged.filter("q0 IS NOT NULL")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("q0").alias("p0"), F.col("q1").alias("p1"))
        .agg(F.count("*").alias("more"))
    )
    counted = merged.join(below, _NODE, "left").withColumn(
        "children", F.col("children") + F.coalesce("more", F.lit(0))
    )
    state = stored(
        counted.select(
            *_NODE,
            *("q0", "q1", "conv", "n", "children"),
            (F.col("leaves") + F.when(F.col("children") == 0, 1).otherwise(0)).alias("leaves"),
            (F.col("saved") + (F.col("n") - 1) * F.col("size")).alias("saved"),
            F.col("q0").alias("a0"),
            F.col("q1").alias("a1"),
        ),
        "trie-sums",
    )
    step = 1  # a0, a1: the node that many levels up
    while not state.filter("a0 IS NOT NULL").isEmpty():
        up = (F.col("depth") - step).alias("depth")
        rising = state.filter("a0 IS NOT NULL")
        given = rising.groupBy(up, F.col("a0").alias("p0"), F.col("a1").alias("p1")).agg(
            F.sum("leaves").alias("g_leaves"), F.sum("saved").alias("g_saved")
        )
        higher = state.select(
            (F.col("depth") + step).alias("depth"),
            F.col("p0").alias("a0"),
            F.col("p1").alias("a1"),
            F.col("a0").alias("b0"),
            F.col("a1").alias("b1"),
        )
        state = stored(
            state.join(given, _NODE, "left")
            .join(higher, ["depth", "a0", "a1"], "left")
            .select(
                *_NODE,
                *("q0", "q1", "conv", "n", "children"),
                *[(F.col(c) + F.coalesce(f"g_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")],
                F.col("b0").alias("a0"),
                F.col("b1").alias("a1"),
            ),
            "trie-sums",
        )
        step *= 2
    return state.drop("a0", "a1")


def _end_digests(ends: DataFrame, together: int) -> DataFrame:
    """``depth, p0, p1, ends_sha256``: the digest of the ascending ids that end at a node.

    Ids are sorted over all tasks and joined to texts of ``together`` ids first. A digest has to read
    its text from left to right, so the texts of a node then pass one task, one after the other.
    """
    order = [*_NODE, "conv"]
    names = [*order, "ids"]
    types = [pa.int64()] * 4 + [pa.string()]

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            columns = [np.asarray(c) for c in batch.columns]
            new = np.concatenate([[True], *[(np.diff(np.stack(columns[:3])) != 0).any(0)]])
            first = np.flatnonzero(new)
            place = np.arange(len(new)) - first[np.cumsum(new) - 1]
            first = np.flatnonzero(place % together == 0)
            ids = columns[3].astype(str)
            own = [c[first] for c in columns] + [[",".join(x) for x in np.split(ids, first[1:])]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(own, types, strict=True)], names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for *own, _, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = own, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            if done:
                yield rows(done)
        if node is not None:
            yield rows([(*node, digest.hexdigest())])

    def rows(done: list[tuple]) -> pa.RecordBatch:
        columns = zip(*done, strict=True)
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [*_NODE, "ends_sha256"]
        )

    joined = (
        ends.select(*order)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(texts, "depth bigint, p0 bigint, p1 bigint, conv bigint, ids string")
    )
    return (
        joined.repartition(*_NODE)
        .sortWithinPartitions(*order)
        .mapInArrow(digests, "depth bigint, p0 bigint, p1 bigint, ends_sha256 string")
    )


def prefix_trie(
    turns: DataFrame,
    convs: DataFrame,
    *,
    shard_turns: int = SHARD_TURNS,
    layer_turns: int = LAYER,
) -> DataFrame:
    """A row for each node of the trie of conversations, the textless root included.

    ``turns(conv, place, h0, h1, size)`` and ``convs(conv, n)`` as from ``turns_of``. Columns, all
    but the last bigint: conv_id (the node's smallest member), depth, parent_conv_id (the parent's
    conv_id; NULL for the root), n_convs, n_children, n_leaves (childless nodes of the subtree),
    saved_tokens (over the subtree, bytes of the last text for each member but one), and ends_sha256,
    over the ids of the members that end there, ascending and joined by commas.

    Without conversations there is no member and no node. Conversations of any length and any number
    of equal ones are taken; their turns are told apart by 128 bits.
    """
    small_batches(turns.sparkSession)
    classes, ends = _stretches(turns, convs, layer_turns)
    order = ["layer", "p0", "p1", "turns"]
    nodes = stored(
        classes.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_nodes(shard_turns, layer_turns), _ROW),
        "trie-nodes",
    )
    upper = _merged(nodes.filter("upper"))
    names = upper.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("p0").alias("q0"),
        F.col("p1").alias("q1"),
        F.col("conv").alias("parent"),
    )
    if upper.count() <= FEW_NODES:
        names = F.broadcast(names)
    columns = [*_NODE, "conv", "parent", "n", "children", "leaves", "saved"]
    inner = nodes.filter("NOT upper")
    looked_up = upper.unionByName(inner.filter("below").select(upper.columns)).join(
        names, ["depth", "q0", "q1"], "left"
    )
    whole = looked_up.select(*columns).unionByName(inner.filter("NOT below").select(*columns))
    return whole.join(_end_digests(ends, IDS_TOGETHER), _NODE, "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )
