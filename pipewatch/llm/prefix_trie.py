"""The trie of conversation prefixes, from balanced parentheses per shard.

A conversation is the path of its turns, 16 bytes of hash a turn. Conversations with one path are one row, and
paths in byte order are the trie in preorder, so a range of paths is a shard of it. A shard writes its trie as a
sequence of parentheses, with the least excess of each block of ``RANGE`` parentheses and of ranges of blocks.
``find_close`` delimits the subtrees; ranks of the pair ``()`` count their leaves; differences of cumulative
arrays give members and savings.

Only nodes on the first or the last path of a shard can lie in other shards too: the shared spine. All others are
finished where they are. Of a spine node a shard passes on what hangs below it, summed, so a shard leaves two paths;
``FAN_IN`` neighbouring shards' spines are the next round's shard, up to a single one. A round's rows are at most two
paths for each shard of the round before, whatever the number of conversations.

``chained``: a conversation may begin with turns of another one, see ``rebuilt``. Texts are hashed before anything is
shuffled. The turns of one conversation, as hashes, are one row. The decimal ids of the members of a path are joined in
pieces by a range sort, so a path of a third of all conversations is spread out; only the SHA-256 over the pieces,
which is defined over all of them in order, is one task's, piece by piece.

Defined results: rows without a conversation id belong to none; NULL roles and texts are empty; a NULL turn
comes first; turns with equal numbers are ordered by role and the hash of their text, and repeated rows are turns each;
whole texts are hashed, however long; an empty table has no nodes at all. Columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pipewatch.llm.common import written

WIDTH = 16
# Parentheses of a block whose least excess is kept; shards whose spines one task merges; bytes of ids in a piece.
RANGE = 64
FAN_IN = 32
PIECE = 1 << 16
HEAD = 8
BASE = 5
SALTS = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()


# -- paths ------------------------------------------------------------------------


def paths(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turns`` (an array of (``hash``, ``bytes``)) in order."""
    spoken, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    # The role's length keeps role and text apart.
    hashed = F.md5(F.concat_ws(":", F.length(spoken).cast("string"), spoken, said).cast("binary"))
    rows = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), spoken.alias("role"), hashed.alias("hash"), F.octet_length(said).cast("long").alias("bytes")).alias("t"),
    )
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["hash"].alias("hash"), t["bytes"].alias("bytes"))).alias("turns"))


def rebuilt(listed: DataFrame) -> DataFrame:
    """Each conversation c after the first h turns of conversation c - c % 5, with h = crc32(c) % 9."""
    listed = written(listed, "turns")
    # At most HEAD turns of one conversation in five.
    heads = listed.where(F.col("conv_id") % BASE == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEAD).alias("head"))
    own = listed.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % BASE).alias("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    first = F.when(F.col("head").isNull(), F.array().cast(listed.schema["turns"].dataType)).otherwise(F.slice("head", F.lit(1), h))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return own.join(heads, "base", "left").select("conv_id", F.concat(first, rest).alias("turns"))


def path_rows(chained: DataFrame) -> DataFrame:
    """Conversations as ``conv_id``, ``path`` (16 bytes a turn), ``path_id``, ``bytes`` (of each turn's text)."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["hash"]), ""))
    return chained.select(
        "conv_id", path.alias("path"), F.md5(path).alias("path_id"), F.transform("turns", lambda t: t["bytes"]).alias("bytes")
    )


def end_digests(members: DataFrame) -> DataFrame:
    """``path_id``, ``ends``: SHA-256 of the decimal ids of its conversations, ascending, joined by commas."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first, held, size = None, None, [], 0
        out = []

        def flush():
            nonlocal held, size
            if held:
                out.append((last, first, ",".join(held)))
            held, size = [], 0

        for batch in batches:
            for path, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path != last or size > PIECE:
                    flush()
                    last, first = path, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
            yield from _rows(out, _PIECES)
            out.clear()
        flush()
        yield from _rows(out, _PIECES)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, out = None, None, []
        for batch in batches:
            for path, piece in zip(batch.column("path_id").to_pylist(), batch.column("piece").to_pylist()):
                if path != last:
                    if last is not None:
                        out.append((last, state.hexdigest()))
                    last, state = path, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            yield from _rows(out, _DIGESTS)
            out.clear()
        if last is not None:
            yield from _rows([(last, state.hexdigest())], _DIGESTS)

    # Sorted over all conversations, so that the members of one path are spread over tasks.
    cut = members.select("path_id", "conv_id").orderBy("path_id", "conv_id").mapInArrow(pieces, "path_id string, first long, piece string")
    dealt = cut.repartition("path_id").sortWithinPartitions("path_id", "first")
    return dealt.mapInArrow(digests, "path_id string, ends string")


_PIECES = pa.schema([("path_id", pa.string()), ("first", pa.int64()), ("piece", pa.string())])
_DIGESTS = pa.schema([("path_id", pa.string()), ("ends", pa.string())])


def _rows(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


# -- balanced parentheses ----------------------------------------------------------


def excess_of(bits: np.ndarray) -> np.ndarray:
    """Open minus closed parentheses up to each place, itself included."""
    return np.cumsum(np.where(bits, 1, -1))


def find_close(excess: np.ndarray, opens: np.ndarray, block: int = RANGE) -> np.ndarray:
    """The place that closes each open parenthesis: the next one with an excess of one less.

    The least excess per block, and per pairs of blocks above it, tells which ranges can hold it: climb
    while the range to the right cannot, descend into the first that can, look through one block.
    """
    want = excess[opens] - 1
    blocks = -(-len(excess) // block)
    size = 1 << max(blocks - 1, 0).bit_length()
    padded = np.full(size * block, np.iinfo(np.int64).max)
    padded[: len(excess)] = excess
    levels = [padded.reshape(size, block).min(axis=1)]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].reshape(-1, 2).min(axis=1))

    found = np.full(len(opens), -1)

    def within(which: np.ndarray, at: np.ndarray, after: np.ndarray) -> None:
        """Looks through one block each, from the places ``after``."""
        for part in range(0, len(which), 1 << 14):
            w, a, s = which[part : part + (1 << 14)], at[part : part + (1 << 14)], after[part : part + (1 << 14)]
            places = a[:, None] * block + np.arange(block)
            hit = (padded[places] == want[w][:, None]) & (places > s[:, None])
            has = hit.any(axis=1)
            found[w[has]] = places[has, hit[has].argmax(axis=1)]

    everyone = np.arange(len(opens))
    own = opens // block
    within(everyone, own, opens)
    left = everyone[found < 0]
    node, level = own[left].copy(), np.zeros(len(left), int)
    climbing = np.ones(len(left), bool)
    while climbing.any():
        # From a left child to its sibling if that can hold the place, else one level up.
        for k in range(len(levels) - 1):
            here = np.flatnonzero(climbing & (level == k))
            even = here[node[here] % 2 == 0]
            can = even[levels[k][node[even] + 1] <= want[left[even]]]
            node[can] += 1
            climbing[can] = False
            up = here[climbing[here]]
            node[up] //= 2
            level[up] += 1
        if (climbing & (level == len(levels) - 1)).any():
            raise ValueError("the parentheses are not balanced")
    for k in range(len(levels) - 1, 0, -1):
        here = np.flatnonzero(level == k)
        below = node[here] * 2
        node[here] = below + (levels[k - 1][below] > want[left[here]])
        level[here] -= 1
    if len(left):
        within(left, node, node * block - 1)
    return found


def least_between(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The least of ``values[start:stop]`` for each range, none of them empty."""
    out = np.empty(len(start), values.dtype)
    lengths, step, table = stop - start, 1, values
    while len(start) and step <= lengths.max():
        now = (lengths >= step) & (lengths < 2 * step)
        out[now] = np.minimum(table[start[now]], table[stop[now] - step])
        if 2 * step <= len(values):
            table = np.minimum(table[:-step], table[step:])
        step *= 2
    return out


# -- one shard's trie ---------------------------------------------------------------

# What a path brings for each of its nodes, from the root (depth 0) on: members ending there or finished
# below it, the smallest of them, finished children, leaves and savings below it, the digest of its ends.
OWN = ["members", "least", "children", "leaves", "saved"]
NONE = (1 << 63) - 1


class Trie:
    """The trie of sorted, different paths, in preorder."""

    def __init__(self, path: list[bytes], sizes: list[np.ndarray], own: list[dict[str, np.ndarray]], ends: list[list]):
        depth = np.array([len(p) // WIDTH for p in path])
        flat = np.frombuffer(b"".join(path), ">u8").reshape(-1, 2)
        start = np.cumsum([0, *depth])
        # How many turns a path shares with the one before it.
        shared = np.zeros(len(path), int)
        for i in range(1, len(path)):
            n = min(depth[i], depth[i - 1])
            a, b = flat[start[i] : start[i] + n], flat[start[i - 1] : start[i - 1] + n]
            differ = (a != b).any(axis=1)
            shared[i] = differ.argmax() if differ.any() else n
        # The first path also brings the root.
        fresh = depth - shared + (np.arange(len(path)) == 0)
        self.nodes = int(fresh.sum())
        self.depth = np.concatenate([np.arange(s + (i > 0), d + 1) for i, (s, d) in enumerate(zip(shared, depth))])
        self.path_of = np.repeat(np.arange(len(path)), fresh)
        self.text_bytes = np.zeros(self.nodes, np.int64)
        self.own = {name: np.full(self.nodes, NONE if name == "least" else 0, np.int64) for name in OWN}
        self.ends = np.full(self.nodes, None, object)

        # Parentheses: close what a path leaves, open what is new on it.
        closes = np.concatenate([[0], depth[:-1] - shared[1:], [depth[-1] + 1]])
        runs = np.stack([closes, np.append(fresh, 0)], axis=1).ravel()
        self.bits = np.repeat(np.tile([False, True], len(path) + 1), runs)
        self.opens = np.flatnonzero(self.bits)
        excess = excess_of(self.bits)
        self.close = find_close(excess, self.opens)
        # Nodes are numbered in preorder: a subtree is a range of numbers.
        self.stop = np.arange(self.nodes) + (self.close - self.opens + 1) // 2

        # The node of each path and depth: the last one of that depth so far.
        by_depth = np.lexsort((np.arange(self.nodes), self.depth))
        keys = self.depth[by_depth] * (self.nodes + 1) + by_depth
        last = np.cumsum(fresh) - 1
        self.parent = np.full(self.nodes, -1)
        inner = np.flatnonzero(self.depth > 0)
        self.parent[inner] = by_depth[np.searchsorted(keys, (self.depth[inner] - 1) * (self.nodes + 1) + inner) - 1]
        self.node_of = []
        for i in range(len(path)):
            levels = np.arange(depth[i] + 1)
            nodes = by_depth[np.searchsorted(keys, levels * (self.nodes + 1) + last[i], side="right") - 1]
            self.node_of.append(nodes)
            self.text_bytes[nodes[1:]] = sizes[i]
            for name in OWN:
                if name == "least":
                    self.own[name][nodes] = np.minimum(self.own[name][nodes], own[i][name])
                else:
                    self.own[name][nodes] += own[i][name]
            for d, digest in enumerate(ends[i]):
                if digest is not None:
                    self.ends[nodes[d]] = digest

    def below(self, values: np.ndarray) -> np.ndarray:
        """The sum of ``values`` over each node's subtree, itself included."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.stop] - total[: self.nodes]

    def totals(self) -> dict[str, np.ndarray]:
        """The six numbers of each node, final where no other shard holds a part of its subtree."""
        members = self.below(self.own["members"])
        # A pair () without finished children is a leaf; its rank at both ends of a subtree counts its leaves.
        pair = self.bits[self.opens] & ~self.bits[self.opens + 1]
        leaves = self.below((pair & (self.own["children"] == 0)).astype(np.int64)) + self.below(self.own["leaves"])
        direct = np.bincount(self.parent[self.parent >= 0], minlength=self.nodes)
        saved = self.below((members - 1) * self.text_bytes) + self.below(self.own["saved"])
        return {
            "members": members,
            "least": least_between(self.own["least"], np.arange(self.nodes), self.stop),
            "children": direct + self.own["children"],
            "leaves": leaves,
            "saved": saved,
        }


_OWN_ARRAYS = [(name, pa.list_(pa.int64())) for name in OWN]
RECORD = "shard long, path binary, bytes array<long>, " + ", ".join(f"{n} array<long>" for n in OWN) + ", ends array<string>"
NODE = (
    "conv_id long, depth long, parent_conv_id long, parent_key binary, node_key binary, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string"
)
_NODE = pa.schema(
    [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("parent_key", pa.binary()), ("node_key", pa.binary())]
    + [(n, pa.int64()) for n in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string())]
)
_RECORD = pa.schema(
    [("shard", pa.int64()), ("path", pa.binary()), ("bytes", pa.list_(pa.int64())), *_OWN_ARRAYS, ("ends", pa.list_(pa.string()))]
)
# Finished nodes and spine paths of a round in one table.
ROUND = f"{NODE}, {RECORD}"
_ROUND = pa.schema([*_NODE, *_RECORD])


def _node_keys(path: bytes) -> list[bytes]:
    """A digest of each prefix of a path, from the root's on."""
    state = hashlib.md5(b"node")
    keys = [state.digest()]
    for i in range(0, len(path), WIDTH):
        state.update(path[i : i + WIDTH])
        keys.append(state.copy().digest())
    return keys


def merge_shard(table: pa.Table, shard: int, first: bool, last: bool) -> Iterator[pa.RecordBatch]:
    """One shard's finished nodes, and its two spine paths unless it is the ``last`` one.

    A finished node whose parent is not waits for that one's key. After the ``first`` round all nodes have
    been on a spine and are given with their keys.
    """
    path = table["path"].to_pylist()
    own = [{name: np.array(v, np.int64) for name, v in zip(OWN, row)} for row in zip(*[table[n].to_pylist() for n in OWN])]
    trie = Trie(path, [np.array(b, np.int64) for b in table["bytes"].to_pylist()], own, table["ends"].to_pylist())
    total = trie.totals()
    spines = [(path[0], trie.node_of[0])] + ([(path[-1], trie.node_of[-1])] if len(path) > 1 else [])
    spine = np.zeros(trie.nodes, bool)
    for _, nodes in spines:
        spine[nodes] = not last
    keys: dict[int, bytes] = {}
    for p, nodes in spines if first else zip(path, trie.node_of):
        keys.update(zip(nodes.tolist(), _node_keys(p)))
    done = np.flatnonzero(~spine)
    parent = trie.parent[done]
    known = (parent >= 0) & ~spine[parent]
    columns = [
        total["least"][done],
        trie.depth[done],
        pa.array(np.where(known, total["least"][parent], 0), pa.int64(), mask=~known),
        [None if k or p < 0 else keys[p] for k, p in zip(known.tolist(), parent.tolist())],
        [None if first else keys[d] for d in done.tolist()],
        *[total[n][done] for n in ("members", "children", "leaves", "saved")],
        [e or NO_ENDS for e in trie.ends[done]],
    ]
    yield _padded(columns, _NODE)
    if last:
        return
    # What hangs below a spine node, summed over its finished children.
    hang = done[spine[parent]]
    above = trie.parent[hang]
    passed = {name: trie.own[name].copy() for name in OWN}
    for name, values in (("members", total["members"]), ("leaves", total["leaves"]), ("saved", total["saved"]), ("children", np.ones(trie.nodes, np.int64))):
        np.add.at(passed[name], above, values[hang])
    np.minimum.at(passed["least"], above, total["least"][hang])
    rows, given = [], np.zeros(trie.nodes, bool)
    for p, nodes in spines:
        # A node of both paths is passed on with the first.
        new = ~given[nodes]
        given[nodes] = True
        own_rows = [np.where(new, passed[n][nodes], NONE if n == "least" else 0).tolist() for n in OWN]
        ends = [e if n else None for e, n in zip(trie.ends[nodes], new)]
        rows.append((shard, p, trie.text_bytes[nodes[1:]].tolist(), *own_rows, ends))
    yield _padded(list(zip(*rows)), _RECORD)


def _padded(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    """The columns of ``schema`` with all others of a round as NULLs."""
    rows = len(columns[0])
    given = {f.name: c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)}
    return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(rows, f.type)) for f in _ROUND], schema=_ROUND)


# -- the whole trie -----------------------------------------------------------------


def _first_round(shared: DataFrame, last: bool) -> DataFrame:
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = list(batches)
        if sum(b.num_rows for b in held):
            yield from merge_shard(pa.Table.from_batches(held), TaskContext.get().partitionId(), True, last)

    return shared.mapInArrow(merge, ROUND)


def _next_round(spines: DataFrame, last: bool) -> DataFrame:
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(merge_shard(table.drop_columns(["group"]).sort_by("path"), key[0].as_py(), False, last), _ROUND)

    grouped = spines.withColumn("group", F.floor(F.col("shard") / FAN_IN).cast("long"))
    return grouped.groupBy("group").applyInArrow(merge, ROUND)


def prefix_trie(chained: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of ``conv_id``, ``turns`` rows; see the contract of ``op13``."""
    spark = chained.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = written(path_rows(chained), "paths")
    distinct = members.groupBy("path_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least_id"), F.first("path").alias("path"), F.first("bytes").alias("bytes")
    )

    def at_end(value: Column, other: Column) -> Column:
        return F.concat(F.array_repeat(other, F.size("bytes")), F.array(value))

    zero = F.lit(0).cast("long")

    records = distinct.join(end_digests(members), "path_id").select(
        zero.alias("shard"),
        "path",
        "bytes",
        at_end(F.col("n"), zero).alias("members"),
        at_end(F.col("least_id"), F.lit(NONE)).alias("least"),
        *[F.array_repeat(zero, F.size("bytes") + 1).alias(n) for n in ("children", "leaves", "saved")],
        at_end(F.col("ends"), F.lit(None).cast("string")).alias("ends"),
    )
    # Written, so that the bounds of the ranges are drawn from the rows that are dealt out.
    ready = written(records, "distinct-paths")
    ranged = ready.repartitionByRange(shards, "path").sortWithinPartitions("path")
    rounds = [written(_first_round(ranged, shards == 1), "trie")]
    left = shards
    while left > 1:
        left = -(-left // FAN_IN)
        spines = rounds[-1].where(F.col("path").isNotNull()).select(*_RECORD.names)
        rounds.append(written(_next_round(spines, left == 1), "trie"))
    nodes = rounds[0]
    for r in rounds[1:]:
        nodes = nodes.unionByName(r)
    return _with_parents(nodes.where(F.col("depth").isNotNull()).select(*_NODE.names))


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Fills in the parents that were on a spine: few nodes, each perhaps with many children, so salted."""
    salt = F.pmod(F.xxhash64("conv_id"), F.lit(SALTS))
    every_salt = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    keyed = nodes.where(F.col("node_key").isNotNull())
    above = keyed.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("above_id"), F.explode(every_salt).alias("salt"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    waiting = nodes.where(F.col("parent_key").isNotNull()).drop("parent_conv_id").withColumn("salt", salt)
    found = waiting.join(above, ["parent_key", "salt"]).withColumnRenamed("above_id", "parent_conv_id")
    return nodes.where(F.col("parent_key").isNull()).select(*out).unionByName(found.select(*out))
