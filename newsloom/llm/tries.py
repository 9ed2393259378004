"""Prefix trie of conversations: balanced parentheses per shard, shared spines merged level by level.

Conversations are sorted by their turns, so a shard, a stretch of that order, holds a whole piece of the trie. In
a shard the trie is a row of parentheses, one pair a node in preorder:

- ``findclose`` delimits a node's subtree. It looks for the excess before the node in blocks with their least excess,
  over a tree of these minima.
- The rank of leaf pairs ``()`` at both ends of a subtree counts its leaves.
- Cumulative arrays over the preorder give sums over a subtree.

Only the nodes on the paths of a shard's first and last conversation, its spines, can also lie in
other shards. The others are finished. The spines, with what was found below them, are the conversations of the
next level, some thousand times fewer; its last level is one shard, where no node stays open. Then the smallest members
of open nodes go back down to the nodes below them that name them as parent.

A turn is known by 128 bits of hash of role and text; texts themselves do not move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.shared import saved

# Fixed values of the rebuilding: conversations that share a first one, and shared turns.
GROUP, TURNS = 100, 6
SHARD = 32_768   # nodes of paths a shard takes, so that memory does not depend on the partition,
LEAST_ROWS = 4   # and conversations, so that every level is smaller than the one below
BLOCK = 64       # parentheses in a block
NONE = np.iinfo(np.int64).max
EMPTY = hashlib.sha256(b"").hexdigest()

SUMS = ["n_convs", "least", "leaves", "saved", "kids"]
TURN = "array<struct<a: long, b: long>>"
LEVEL = f"""kind string, shard long, side int, conv_id long, depth long, parent_conv_id long, parent_side int, n_convs long, n_children long,
 n_leaves long, saved_tokens long, ends string, ids string, path {TURN}, chars array<long>, {", ".join(f"{c}s array<long>" for c in SUMS)},
 from_shard long, from_side int, open int"""


def excess_closes(bits: np.ndarray) -> np.ndarray:
    """Place of the closing parenthesis of each opening one, in order (``bits``: 1 opens)."""
    excess = np.cumsum(np.where(bits, 1, -1))
    size = len(bits)
    blocks = 1 << max(0, -(-size // BLOCK) - 1).bit_length()
    padded = np.full(blocks * BLOCK, size + 1, dtype=np.int64)
    padded[:size] = excess
    grid = padded.reshape(blocks, BLOCK)
    # The least excess of every block, then of every two, four, ... of them: node i has the children 2 i and 2 i + 1.
    least = np.full(2 * blocks, size + 1, dtype=np.int64)
    least[blocks:] = grid.min(axis=1)
    for i in range(blocks.bit_length() - 1, 0, -1):
        low, high = 1 << (i - 1), 1 << i
        least[low:high] = np.minimum(least[2 * low:2 * high:2], least[2 * low + 1:2 * high:2])
    opens = np.flatnonzero(bits)
    out = np.empty(len(opens), dtype=np.int64)
    for at in range(0, len(opens), 1 << 16):
        place = opens[at:at + (1 << 16)]
        target, block = excess[place] - 1, place // BLOCK

        def first(blocks_of: np.ndarray, wanted: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            hit = (grid[blocks_of] <= wanted[:, None]) & (np.arange(BLOCK) > after[:, None])
            return hit.any(axis=1), blocks_of * BLOCK + hit.argmax(axis=1)

        found, where = first(block, target, place % BLOCK)
        far = np.flatnonzero(~found)
        if len(far):
            node, wanted = block[far] + blocks, target[far]
            # Up until the tree holds a small enough minimum to the right, then down to its first block.
            seeking = np.ones(len(far), dtype=bool)
            while seeking.any():
                right = seeking & (node % 2 == 0)
                hit = right & (least[np.minimum(node + 1, 2 * blocks - 1)] <= wanted)
                node[hit] += 1
                seeking &= ~hit
                node[seeking] //= 2
            while (inner := node < blocks).any():
                node[inner] *= 2
                node[inner & (least[np.minimum(node, 2 * blocks - 1)] > wanted)] += 1
            where[far] = first(node - blocks, wanted, np.full(len(far), -1))[1]
        out[at:at + len(place)] = where
    return out


def common(lengths: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of turns the rows ``left[i]`` and ``right[i]`` begin with in common."""
    out = np.zeros(len(left), dtype=np.int64)
    going, d = np.arange(len(left)), 0
    while len(going):
        going = going[np.minimum(lengths[left[going]], lengths[right[going]]) > d]
        x, y = starts[left[going]] + d, starts[right[going]] + d
        going = going[(a[x] == a[y]) & (b[x] == b[y])]
        out[going] += 1
        d += 1
    return out


class Trie:
    """The trie of sorted rows. ``a, b``: the turns of all rows; ``lengths``: their number a row."""

    def __init__(self, lengths: np.ndarray, a: np.ndarray, b: np.ndarray):
        rows = len(lengths)
        starts = np.cumsum(lengths) - lengths
        every = np.arange(rows)
        lcp = np.r_[-1, common(lengths, starts, a, b, every[:-1], every[1:])]
        # One entry for each row and depth, the root's first.
        self.row = np.repeat(every, lengths + 1)
        self.begin = np.cumsum(lengths + 1) - lengths - 1
        self.level = np.arange(len(self.row)) - self.begin[self.row]
        new = self.level > lcp[self.row]
        number = np.cumsum(new) - 1
        # An entry that is not new is the node of its depth that came last.
        order = np.lexsort((self.row, self.level))
        last = np.maximum.accumulate(np.where(new[order], np.arange(len(order)), 0))
        self.node = np.empty(len(order), dtype=np.int64)
        self.node[order] = number[order][last]
        self.entry = np.flatnonzero(new)
        self.depth = self.level[new]
        self.size = len(self.depth)
        self.parent = np.where(self.depth > 0, self.node[self.entry - 1], -1)
        opens = 2 * np.arange(self.size) - self.depth
        bits = np.zeros(2 * self.size, dtype=np.int8)
        bits[opens] = 1
        closes = excess_closes(bits)
        self.after = np.arange(self.size) + (closes - opens + 1) // 2  # first node behind the subtree
        pairs = np.r_[0, np.cumsum(bits & ~np.r_[bits[1:], 0] & 1)]
        self.leaf_pairs = pairs[closes + 1] - pairs[opens]
        self.leaf = np.r_[bits[opens + 1] == 0]
        self.to_first = common(lengths, starts, a, b, every, np.zeros(rows, dtype=np.int64))
        self.to_last = common(lengths, starts, a, b, every, np.full(rows, rows - 1))

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value over the subtree of each node."""
        total = np.r_[0, np.cumsum(values)]
        return total[self.after] - total[:-1]

    def summed(self, entries: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size, dtype=np.int64)
        np.add.at(out, self.node, entries)
        return out


def _solved(table: pa.Table, shard: int, first_level: bool, last_level: bool) -> dict[str, list]:
    """Finished nodes, spines, end lists and look-ups of one shard, as rows of ``LEVEL``."""
    path = table.column("path").combine_chunks()
    lengths = pc.list_value_length(path).to_numpy(zero_copy_only=False).astype(np.int64)
    turns = path.flatten()
    a, b = (turns.field(i).to_numpy(zero_copy_only=False) for i in range(2))
    flat_chars = table.column("chars").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    trie = Trie(lengths, a, b)
    rows = len(lengths)
    if first_level:
        conv = table.column("conv_id").to_numpy()
        given = {"n_convs": np.ones(len(trie.row), dtype=np.int64), "least": conv[trie.row]}
        given |= {c: np.zeros(len(trie.row), dtype=np.int64) for c in SUMS[2:]}
    else:
        given = {c: table.column(c + "s").combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in SUMS}
    n_convs, leaves, below, kids = (trie.summed(given[c]) for c in ("n_convs", "leaves", "saved", "kids"))
    least = np.full(trie.size, NONE)
    np.minimum.at(least, trie.node, given["least"])
    chars = np.zeros(trie.size, dtype=np.int64)
    inner = trie.depth > 0
    first_turn = trie.entry - trie.row[trie.entry] - 1  # of a node's entry, without the roots' entries
    chars[inner] = flat_chars[first_turn[inner]]

    is_open = np.zeros(trie.size, dtype=bool)
    if not last_level:
        is_open[trie.node[:lengths[0] + 1]] = True
        is_open[trie.node[trie.begin[-1]:]] = True
    children = np.zeros(trie.size, dtype=np.int64)
    np.add.at(children, trie.parent[inner], 1)
    n_children = children + kids
    # Leaf pairs, and what was closed below; a pair with closed children is no leaf.
    n_leaves = trie.leaf_pairs + trie.below(leaves - (trie.leaf & (kids > 0)))
    own = (n_convs - 1) * chars
    saved_tokens = trie.below(below + np.where(is_open, 0, own))

    ends: dict[int, list[int]] = {}
    if first_level:
        for node, name in zip(trie.node[trie.begin + lengths].tolist(), conv.tolist()):
            ends.setdefault(node, []).append(name)
    joined = {node: ",".join(map(str, ids)) for node, ids in ends.items()}

    out: dict[str, list] = {c: [] for c in _COLUMNS}

    def put(**values) -> None:
        for c in _COLUMNS:
            out[c].append(values.get(c))

    side_of = np.zeros(trie.size, dtype=np.int64)  # of an open node: 0 for the first row's spine, 1 for the last one's
    side_of[trie.node[trie.begin[-1]:]] = 1
    side_of[trie.node[:lengths[0] + 1]] = 0
    for k in np.flatnonzero(~is_open).tolist():
        parent = int(trie.parent[k])
        waits = parent >= 0 and bool(is_open[parent])
        put(kind="node", shard=shard, conv_id=int(least[k]), depth=int(trie.depth[k]),
            parent_conv_id=int(least[parent]) if parent >= 0 and not waits else None, parent_side=int(side_of[parent]) if waits else None,
            n_convs=int(n_convs[k]), n_children=int(n_children[k]), n_leaves=int(n_leaves[k]), saved_tokens=int(saved_tokens[k]),
            ends=(hashlib.sha256(joined[k].encode()).hexdigest() if k in joined else EMPTY) if first_level else None)
    for k in np.flatnonzero(is_open).tolist():
        if k in joined:
            put(kind="ends", shard=shard, side=int(side_of[k]), depth=int(trie.depth[k]), conv_id=ends[k][0], ids=joined[k])
    if not last_level:
        closed_leaves = n_leaves.copy()
        # Of an open node: what lies in closed subtrees directly below it, and what it was given.
        add = {"leaves": leaves.copy(), "saved": below.copy(), "kids": kids.copy()}
        top = np.flatnonzero(~is_open)
        top = top[is_open[trie.parent[top]]]
        np.add.at(add["leaves"], trie.parent[top], closed_leaves[top])
        np.add.at(add["saved"], trie.parent[top], saved_tokens[top])
        np.add.at(add["kids"], trie.parent[top], 1)
        add |= {"n_convs": n_convs, "least": least}
        for side, row in ((0, 0), (1, rows - 1)):
            nodes = trie.node[trie.begin[row]:trie.begin[row] + lengths[row] + 1]
            mine = side_of[nodes] == side
            if side and not mine.any():
                # Nothing of its own, but it may have to answer for rows that look it up; those look at the other side.
                continue
            values = {c + "s": np.where(mine, add[c][nodes], NONE if c == "least" else 0).tolist() for c in SUMS}
            put(kind="spine", shard=shard, side=side, path=path[row].as_py(), chars=table.column("chars")[row].as_py(), **values)
    if not first_level:
        from_shard, from_side = (table.column(c).to_pylist() for c in ("shard", "side"))
        for row in range(rows):
            nodes = trie.node[trie.begin[row]:trie.begin[row] + lengths[row] + 1]
            by_last = trie.to_last[row] > trie.to_first[row]
            shared = int(max(trie.to_last[row], trie.to_first[row])) + 1
            put(kind="look", shard=shard, side=int(by_last), from_shard=from_shard[row], from_side=from_side[row],
                open=0 if last_level else shared, leasts=least[nodes].tolist())
    return out


_COLUMNS = [part.strip().split(" ")[0] for part in LEVEL.replace(TURN, "x").split(",")]


def _cut(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.Table]:
    """Shards of ``SHARD`` path nodes, and ``LEAST_ROWS`` rows, or what remains; the last level is one shard."""
    waiting, nodes, rows = [], 0, 0
    for batch in batches:
        sizes = (pc.list_value_length(batch.column("path")).to_numpy(zero_copy_only=False) + 1).tolist()
        begin = 0
        for i, size in enumerate(sizes):
            nodes, rows = nodes + size, rows + 1
            if nodes >= SHARD and rows >= LEAST_ROWS and not whole:
                yield pa.Table.from_batches([*waiting, batch.slice(begin, i + 1 - begin)])
                waiting, nodes, rows, begin = [], 0, 0, i + 1
        if begin < len(sizes):
            waiting.append(batch.slice(begin))
    if waiting:
        yield pa.Table.from_batches(waiting)


def _level(first_level: bool, last_level: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for number, table in enumerate(_cut(batches, last_level)):
            out = _solved(table, task + number, first_level, last_level)
            size = len(out["kind"])
            for at in range(0, size, 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name][at:at + 10_000], f.type) for f in schema], schema=schema)
    return run


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, path, chars): the first turns of the group's first conversation, then the own ones behind as many.

    Turns are in order of ``turn``, null first, ties by what they hold; a null role or text is empty, a null ``conv_id`` is no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct("turn", F.xxhash64(role, text).alias("a"), F.xxhash64(text, role, F.lit(7)).alias("b"), F.length(text).cast("long").alias("n"))
    own = turns.filter(F.col("conv_id").isNotNull()).groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("own"))
    own = saved(own, "conversations")
    group = F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP))
    heads = own.filter(F.pmod("conv_id", F.lit(GROUP)) == 0).select(F.col("conv_id").alias("group"), F.slice("own", 1, TURNS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % TURNS).cast("int")
    none = F.array().cast(own.schema["own"].dataType)
    whole = own.withColumn("group", group).join(heads, "group", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("head", none), F.lit(1), h), F.slice("own", h + 1, F.size("own"))).alias("turns"))
    return whole.select("conv_id", F.transform("turns", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"))).alias("path"), F.col("turns.n").alias("chars"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined ids of each node; its parts come in order and are never held together."""
    node, digest = None, None
    for batch in batches:
        out = []
        for conv_id, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids"))):
            if (conv_id, depth) != node:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (conv_id, depth), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if out:
            yield _ends(out)
    if node:
        yield _ends([(*node, digest.hexdigest())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    conv, depth, ends = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), pa.array(ends, pa.string())], ["conv_id", "depth", "found"])


def nodes(paths: DataFrame) -> DataFrame:
    """Every node of the trie of rows (conv_id, path, chars): see :func:`prefix_trie`."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = paths.sparkSession
    schema = to_arrow_schema(StructType.fromDDL(LEVEL))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, levels, before = saved(paths, "paths"), [], None
    while True:
        count, size = rows.agg(F.count("*"), F.sum(F.size("path") + 1)).first()
        # A few very long paths are the last level too: shards of them leave as many spines.
        last = (size or 0) <= SHARD or count <= 2 * LEAST_ROWS or count == before
        before = count
        first = not levels
        order = ["path", "conv_id"] if first else ["path", "shard", "side"]
        dealt = rows.coalesce(1) if last else rows.repartitionByRange(max(1, min(tasks, count // 64)), *order)
        level = saved(dealt.sortWithinPartitions(*order).mapInArrow(_level(first, last, schema), LEVEL), "level")
        levels.append(level)
        if last:
            break
        rows = level.filter("kind = 'spine'").select("shard", "side", "path", "chars", *[c + "s" for c in SUMS])
    return _resolved(levels)


def _resolved(levels: list[DataFrame]) -> DataFrame:
    """Nodes of all levels, with the parents and ends that were open in their own."""
    done, known = None, None  # known: final smallest members along the spines of the level below
    ends = None
    for i in range(len(levels) - 1, -1, -1):
        level = levels[i]
        found = level.filter("kind = 'node'")
        if known is not None:
            up = known.select("shard", F.col("side").alias("parent_side"), F.col("final").alias("_up"))
            waiting = found.filter("parent_side is not null").drop("parent_conv_id").join(up, ["shard", "parent_side"])
            waiting = waiting.withColumn("parent_conv_id", F.element_at("_up", F.col("depth").cast("int")))
            found = found.filter("parent_side is null").select(*OUT).unionByName(waiting.select(*OUT))
        if i == 0 and known is not None:
            parts = level.filter("kind = 'ends'").select("shard", "side", "depth", F.col("conv_id").alias("first"), "ids").join(known, ["shard", "side"])
            parts = parts.select(F.element_at("final", F.col("depth").cast("int") + 1).alias("conv_id"), "depth", "first", "ids")
            tasks = int(level.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            dealt = parts.repartition(tasks, "conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
            ends = dealt.mapInArrow(_hashed, "conv_id long, depth long, found string")
        if i:
            found = found.select(*OUT)
            done = found if done is None else done.unionByName(found)
            look = level.filter("kind = 'look'").select("from_shard", "from_side", "shard", "side", "open", "leasts")
            if known is not None:
                local = F.slice("leasts", F.col("open") + 1, F.size("leasts"))
                look = look.join(known, ["shard", "side"]).withColumn("leasts", F.concat(F.slice("final", F.lit(1), F.col("open")), local))
            known = look.select(F.col("from_shard").alias("shard"), F.col("from_side").alias("side"), F.col("leasts").alias("final"))
        else:
            lowest = found.select(*OUT)
    if done is None:
        return lowest.withColumnRenamed("ends", "ends_sha256")
    upper = done.join(ends, ["conv_id", "depth"], "left").withColumn("ends", F.coalesce("found", F.lit(EMPTY))).select(*OUT)
    return lowest.unionByName(upper).withColumnRenamed("ends", "ends_sha256")


OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations from rows (conv_id, turn, role, text), one row a node.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256). A node is named by its smallest
    member and its depth. Repeated turns stay turns; other columns are not read. An empty table gives an empty result. One conversation
    has to fit in a task, at 24 bytes a turn.
    """
    return nodes(rebuilt(turns))
