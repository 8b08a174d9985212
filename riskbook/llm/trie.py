"""The prefix trie of all conversations, by z-fast tries of batches.

A conversation is a path of turns; every prefix has a 128-bit digest (XOR of one number per position
and turn, so prefixes are running XORs). Batches of conversations are inserted into z-fast tries: a
hash table finds a compacted node by the digest at its handle, the depth within its edge that is
divisible by the largest power of two. The exit node of a new conversation is located by fat
binary search over these depths (a logarithmic number of look-ups, however long the conversation);
there the edge is split and the rest of the conversation becomes a leaf. Counts are summed
over the compacted nodes, edges are expanded to one row per depth, and batches meet in a partially
aggregated sum by (depth, digest): a first turn that a third of the conversations share is one row per batch.

What a node's subtree holds follows without walking the tree. The smallest member of a node owns it, and
owns all deeper nodes of its own path, too; so each conversation needs only the depth at which it
leaves the paths of smaller ones. Children, leaves and distinct texts are then sums over owners' paths.

Turns are numbered over sorted ranges, never by gathering a conversation. One of more than ``LONG``
turns is not put into a batch; its path goes to the merge row by row, which gives the same nodes. The ids that end at a node
are hashed in order by a task that streams text chunks of at most ``ENDS`` ids (SHA-256 has one order).

Defined results: rows without conv_id take no part; null role or text is empty; turns in order of turn
(null first), equal turns by role, then md5 of the text; a conversation whose rebuilt form has no turn belongs to the root; an empty
table gives no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.functions.ranking import in_ranges
from riskbook.llm.common import stored
from riskbook.llm.duck import crc32

BLOCK = 100
HEADS = 6
LONG = 4096
BATCH_ROWS = 16384
ENDS = 4096

NODE = "depth long, p1 long, p2 long, q1 long, q2 long, cp long, n_convs long, n_going long, below long, conv_id long"


def head_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its block."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("long")


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), g1, g2 (the turn's digest), cp (code points), _part, _at for each turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    half = lambda at: F.conv(F.substring("_d", at, 15), 16, 10).cast("long")
    slim = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("_role"), F.md5(text.cast("binary")).alias("_t"), digest.alias("_d"), F.length(text).cast("long").alias("cp")
    )
    slim = slim.select("conv_id", "turn", "_role", "_t", half(1).alias("g1"), half(16).alias("g2"), "cp")
    placed = in_ranges(slim, "conv_id", F.col("turn").asc_nulls_first(), "_role", "_t")
    inside = Window.partitionBy("_part", "conv_id").orderBy("_at")
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_part", "conv_id").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select("_part", "conv_id", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rows = placed.withColumn("_row", F.row_number().over(inside)).join(counts, ["_part", "conv_id"])
    return rows.select("conv_id", (F.col("_off") + F.col("_row")).alias("pos"), "g1", "g2", "cp", "_part", "_at")


def _xor(*columns: Column) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out.bitwiseXOR(c)
    return out


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, depth, p1, p2 (prefix), q1, q2 (prefix less the last turn), cp, below (code points from this depth
    on), size (turns): one row for each prefix of each rebuilt conversation, the empty one included."""
    own = stored(numbered(turns), "trie-turns")
    convs = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own"))
    convs = convs.select("conv_id", "n_own", head_turns(F.col("conv_id")).alias("h"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"))
    convs = stored(convs, "trie-convs")
    first = convs.select(F.col("conv_id").alias("_base"), F.col("n_own").alias("n_base"))
    info = convs.join(first, F.col("base") == F.col("_base"), "left").drop("_base")
    info = info.withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
    info = stored(info.withColumn("size", F.col("m") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))), "trie-info")
    # Numbers of a turn at a place: XORs of them are the digests of prefixes.
    x = lambda d: [F.xxhash64("g1", "g2", d), F.xxhash64(F.lit(1), d, "g2", "g1")]

    # The turns taken from the block's first conversation: fewer than HEADS rows for each conversation.
    heads = own.where((F.col("conv_id") % BLOCK == 0) & (F.col("pos") < HEADS)).select(F.col("conv_id").alias("_b"), F.col("pos").alias("depth"), "g1", "g2", "cp")
    heads = info.join(heads, F.col("base") == F.col("_b")).where(F.col("depth") <= F.col("h")).select("conv_id", "size", "depth", "cp", *[c.alias(f"x{i}") for i, c in enumerate(x("depth"))])
    upto = Window.partitionBy("conv_id").orderBy("depth")
    heads = heads.select("conv_id", "size", "depth", "cp", "x0", "x1", F.bit_xor("x0").over(upto).alias("p1"), F.bit_xor("x1").over(upto).alias("p2"), F.sum("cp").over(upto).alias("reached"))
    heads = stored(heads, "trie-heads")
    taken = heads.groupBy("conv_id").agg(F.bit_xor("x0").alias("h1"), F.bit_xor("x1").alias("h2"), F.sum("cp").alias("h_cp"))

    rest = own.join(info.select("conv_id", "h", "m", "size"), "conv_id").where(F.col("pos") > F.col("h"))
    rest = rest.withColumn("depth", F.col("pos") - F.col("h") + F.col("m"))
    rest = stored(rest.select("conv_id", "size", "depth", "cp", "_part", "_at", *[c.alias(f"x{i}") for i, c in enumerate(x("depth"))]), "trie-rest")
    inside = Window.partitionBy("_part", "conv_id").orderBy("_at")
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rest.groupBy("_part", "conv_id").agg(F.bit_xor("x0").alias("a"), F.bit_xor("x1").alias("b"), F.sum("cp").alias("c"))
    zero = F.lit(0).cast("long")
    parts = parts.select("_part", "conv_id", *[F.coalesce(f(c).over(before), zero).alias(f"{c}0") for f, c in ((F.bit_xor, "a"), (F.bit_xor, "b"), (F.sum, "c"))])
    parts = parts.join(taken, "conv_id", "left")
    none = lambda c: F.coalesce(F.col(c), zero)
    rest = rest.withColumns({"in1": F.bit_xor("x0").over(inside), "in2": F.bit_xor("x1").over(inside), "in3": F.sum("cp").over(inside)}).join(parts, ["_part", "conv_id"])
    rest = rest.select(
        "conv_id", "size", "depth", "cp", "x0", "x1", _xor(F.col("in1"), F.col("a0"), none("h1")).alias("p1"), _xor(F.col("in2"), F.col("b0"), none("h2")).alias("p2"),
        (F.col("in3") + F.col("c0") + none("h_cp")).alias("reached"),
    )
    root = info.select("conv_id", "size", *[zero.alias(c) for c in ("depth", "cp", "x0", "x1", "p1", "p2", "reached")])
    rows = root.unionByName(heads).unionByName(rest)
    total = heads.select("conv_id", "cp").unionByName(rest.select("conv_id", "cp")).groupBy("conv_id").agg(F.sum("cp").alias("total"))
    rows = rows.join(total, "conv_id", "left")
    below = F.coalesce("total", zero) - F.col("reached") + F.col("cp")
    return rows.select("conv_id", "depth", "p1", "p2", _xor(F.col("p1"), F.col("x0")).alias("q1"), _xor(F.col("p2"), F.col("x1")).alias("q2"), "cp", below.alias("below"), "size")


def handle(top: int, extent: int) -> int:
    """The two-fattest number in (top, extent]: the one divisible by the largest power of two."""
    return extent & (-1 << ((top ^ extent).bit_length() - 1))


class Node:
    """A compacted node: the prefixes of ``path`` at depths top+1 .. extent."""

    __slots__ = ("top", "extent", "path", "parent", "children", "ends")

    def __init__(self, top: int, extent: int, path: int, parent: Node | None):
        self.top, self.extent, self.path, self.parent = top, extent, path, parent
        self.children: dict[tuple, Node] = {}
        self.ends: list[int] = []


class ZFastTrie:
    """Compacted trie over paths of prefix digests. ``paths[i][d]`` is the digest of path i's first d turns."""

    def __init__(self, paths: list[list[tuple]]):
        self.paths = paths
        self.root = Node(-1, 0, 0, None)
        self.table: dict[tuple, Node] = {}
        self.probes = 0
        for i in range(len(paths)):
            self.insert(i)

    def _enter(self, node: Node) -> None:
        at = handle(node.top, node.extent)
        self.table[at, self.paths[node.path][at]] = node

    def exit_node(self, path: list[tuple]) -> tuple[Node, int]:
        """The node in whose edge the path leaves the trie (or ends), and the depth reached."""
        lo, hi, at = 0, len(path) - 1, self.root
        while lo < hi:
            depth = handle(lo, hi)
            self.probes += 1
            node = self.table.get((depth, path[depth]))
            if node is None:
                hi = depth - 1
            elif node.extent < len(path) and path[node.extent] == self.paths[node.path][node.extent]:
                lo, at = node.extent, node
            else:
                at = node
                break
        else:
            # The edge that starts with the next turn, if any, is left before its handle.
            child = at.children.get(path[lo + 1]) if lo + 1 < len(path) else None
            if child is None:
                return at, lo
            at = child
        other, low, high = self.paths[at.path], lo, min(at.extent, len(path) - 1)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if path[middle] == other[middle] else (low, middle - 1)
        return at, low

    def insert(self, i: int) -> None:
        path = self.paths[i]
        node, depth = self.exit_node(path)
        if depth < node.extent:  # split the edge there
            digests, parent = self.paths[node.path], node.parent
            del self.table[(h := handle(node.top, node.extent)), digests[h]]
            upper = Node(node.top, depth, node.path, parent)
            parent.children[digests[node.top + 1]] = upper
            upper.children[digests[depth + 1]] = node
            node.top, node.parent = depth, upper
            self._enter(upper)
            self._enter(node)
            node = upper
        if depth < len(path) - 1:
            leaf = Node(depth, len(path) - 1, i, node)
            node.children[path[depth + 1]] = leaf
            self._enter(leaf)
            node = leaf
        node.ends.append(i)

    def bottom_up(self) -> list[Node]:
        order, todo = [], [self.root]
        while todo:
            node = todo.pop()
            order.append(node)
            todo.extend(node.children.values())
        return order[::-1]


def _batch_nodes(rows: pd.DataFrame) -> pd.DataFrame:
    """The expanded nodes of one batch: counts over its conversations only."""
    rows = rows.sort_values(["conv_id", "depth"], kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(rows["conv_id"].to_numpy()) != 0])
    bounds = np.r_[starts, len(rows)]
    digests = list(zip(rows["p1"].tolist(), rows["p2"].tolist(), strict=True))
    ids, cps, below = rows["conv_id"].to_numpy()[starts], rows["cp"].to_numpy(), rows["below"].to_numpy()
    trie = ZFastTrie([digests[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
    sums: dict[int, tuple[int, int, int]] = {}  # of a node: members, smallest conv_id, code points from its extent on
    out = []
    for node in trie.bottom_up():
        under = [sums.pop(id(c)) for c in node.children.values()]
        at = starts[node.path]
        n = len(node.ends) + sum(u[0] for u in under)
        conv = min([int(ids[i]) for i in node.ends] + [u[1] for u in under])
        # Children report the code points from their first depth on; this node's own text counts for every member.
        points = sum(u[2] for u in under) + n * int(cps[at + node.extent])
        going = n - len(node.ends)
        for depth in range(node.extent, node.top, -1):
            if depth < node.extent:
                points += n * int(cps[at + depth])
                going = n
            p, q = digests[at + depth], digests[at + depth - 1] if depth else (0, 0)
            out.append((depth, *p, *q, int(cps[at + depth]), n, going, points, conv))
        sums[id(node)] = (n, conv, points)
    return pd.DataFrame(out, columns=[c.split()[0] for c in NODE.split(", ")])


def nodes_of(path_rows: DataFrame) -> DataFrame:
    """Every node once: depth, p1, p2, q1, q2, cp, n_convs, n_going (members that go on), below (code points of all members from
    its depth on), conv_id (smallest member)."""
    batches = max(1, -(-path_rows.count() // BATCH_ROWS))
    short = path_rows.where(F.col("size") <= LONG).withColumn("_batch", F.pmod(F.xxhash64("conv_id"), F.lit(batches)))
    tries = short.select("_batch", "conv_id", "depth", "p1", "p2", "cp", "below").groupBy("_batch").applyInPandas(_batch_nodes, NODE)
    one = F.lit(1).cast("long")
    lone = path_rows.where(F.col("size") > LONG).select(
        "depth", "p1", "p2", "q1", "q2", "cp", one.alias("n_convs"), (F.col("depth") < F.col("size")).cast("long").alias("n_going"), "below", "conv_id"
    )
    total = lambda c: F.sum(c).alias(c)
    return tries.unionByName(lone).groupBy("depth", "p1", "p2").agg(
        F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.max("cp").alias("cp"), total("n_convs"), total("n_going"), total("below"), F.min("conv_id").alias("conv_id")
    )


def _stream_sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and place: the texts of a node, comma-joined, as one SHA-256."""
    key, digest = None, None
    schema = pa.schema([("depth", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("ends_sha256", pa.string())])
    for batch in batches:
        done = []
        for depth, p1, p2, text in zip(*(batch.column(c).to_pylist() for c in ("depth", "p1", "p2", "ids")), strict=True):
            if key != (depth, p1, p2):
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = (depth, p1, p2), hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*key, digest.hexdigest()), schema, strict=True)], schema=schema)


def ends(path_rows: DataFrame) -> DataFrame:
    """depth, p1, p2, ends_sha256 of the nodes at which conversations end."""
    last = path_rows.where(F.col("depth") == F.col("size")).select("depth", "p1", "p2", "conv_id")
    placed = in_ranges(last, "depth", "p1", "p2", "conv_id")
    chunk = placed.groupBy("depth", "p1", "p2", "_part", F.expr(f"_at div {ENDS}").alias("_chunk")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    texts = chunk.select("depth", "p1", "p2", F.get("ids", F.lit(0)).alias("_first"), F.concat_ws(",", F.transform("ids", lambda i: i.cast("string"))).alias("ids"))
    ordered = texts.repartition("depth", "p1", "p2").sortWithinPartitions("depth", "p1", "p2", "_first")
    return ordered.select("depth", "p1", "p2", "ids").mapInArrow(_stream_sha, "depth long, p1 long, p2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    path_rows = stored(paths(turns), "trie-paths")
    nodes = stored(nodes_of(path_rows), "trie-nodes")
    # An owner's first node, that node's parent, and whether its last node has no child.
    owners = nodes.groupBy("conv_id").agg(
        F.min(F.struct("depth", "q1", "q2")).alias("first"), F.max(F.struct(F.col("depth"), (F.col("n_going") == 0).cast("long").alias("leaf"))).alias("last")
    )
    owners = owners.select("conv_id", F.col("first.depth").alias("own"), F.col("first.q1").alias("q1"), F.col("first.q2").alias("q2"), F.col("last.leaf").alias("leaf"))
    above = nodes.select((F.col("depth") + 1).alias("_d"), F.col("p1").alias("_p1"), F.col("p2").alias("_p2"), F.col("conv_id").alias("exit_conv"))
    owners = owners.join(above, (F.col("own") == F.col("_d")) & (F.col("q1") == F.col("_p1")) & (F.col("q2") == F.col("_p2")), "left")
    owners = stored(owners.select(F.col("conv_id").alias("_c"), "own", "leaf", "exit_conv"), "trie-owners")

    walked = path_rows.join(owners.select("_c", "own", "leaf"), F.col("conv_id") == F.col("_c"))
    start = walked.where(F.col("depth") == F.col("own")).select(F.col("_c").alias("_s"), F.col("below").alias("fresh"))
    walked = walked.join(start, F.col("conv_id") == F.col("_s"))
    zero = F.lit(0).cast("long")
    child = ((F.col("own") <= F.col("depth") + 1) & (F.col("depth") < F.col("size"))).cast("long")
    sums = walked.select(
        "depth", "p1", "p2", child.alias("n_children"), F.col("leaf").alias("n_leaves"), F.when(F.col("depth") >= F.col("own"), F.col("below")).otherwise(F.col("fresh")).alias("distinct"),
        zero.alias("n_convs"), zero.alias("below"), F.lit(None).cast("long").alias("conv_id"), F.lit(None).cast("string").alias("ends_sha256"),
    )
    counted = nodes.select("depth", "p1", "p2", *[zero.alias(c) for c in ("n_children", "n_leaves", "distinct")], "n_convs", "below", "conv_id", F.lit(None).cast("string").alias("ends_sha256"))
    ended = ends(path_rows).select("depth", "p1", "p2", *[zero.alias(c) for c in ("n_children", "n_leaves", "distinct", "n_convs", "below")], F.lit(None).cast("long").alias("conv_id"), "ends_sha256")
    total = lambda c: F.sum(c).alias(c)
    merged = sums.unionByName(counted).unionByName(ended).groupBy("depth", "p1", "p2").agg(
        *[total(c) for c in ("n_children", "n_leaves", "distinct", "n_convs", "below")], F.min("conv_id").alias("conv_id"), F.max("ends_sha256").alias("ends_sha256")
    )
    parent = F.when(F.col("depth") > 0, F.when(F.col("depth") == F.col("own"), F.col("exit_conv")).otherwise(F.col("conv_id")))
    return merged.join(owners, F.col("conv_id") == F.col("_c")).select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", (F.col("below") - F.col("distinct")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def oracle_sql() -> str:
    """The same as DuckDB SQL: prefixes as running texts, subtrees by the paths of the nodes' smallest members."""
    return f"""
with own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), md5(coalesce(text, ''))) as pos
  from conversations where conv_id is not null),
info as (select conv_id, {crc32("conv_id::varchar")} % {HEADS} as h, conv_id - conv_id % {BLOCK} as base from (select distinct conv_id from own)),
heads as (select i.conv_id, o.pos as d, o.role, o.text from info i join own o on o.conv_id = i.base and o.pos <= i.h),
taken as (select conv_id, count(*) as m from heads group by conv_id),
turns as (
  select * from heads
  union all select o.conv_id, o.pos - i.h + coalesce(t.m, 0), o.role, o.text from own o join info i using (conv_id) left join taken t using (conv_id) where o.pos > i.h),
prefixes as (
  select conv_id, d, length(text) as cp, string_agg(md5(role) || md5(text), '') over (partition by conv_id order by d) as k from turns
  union all select conv_id, 0, 0, '' from info),
path as (
  select conv_id, d, cp, md5(k) as k, lag(md5(k)) over (partition by conv_id order by d) as up, max(d) over (partition by conv_id) as size from prefixes),
node as (select d, k, any_value(up) as up, any_value(cp) as cp, min(conv_id) as conv_id, count(*) as n from path group by d, k),
children as (select d - 1 as d, up as k, count(*) as n_children from node where d > 0 group by all),
full_node as (select n.*, coalesce(c.n_children, 0) as n_children from node n left join children c using (d, k)),
subtree as (
  select p.d, p.k, sum(case when u.n_children = 0 then 1 else 0 end)::bigint as n_leaves, sum((u.n - 1) * u.cp)::bigint as saved
  from full_node u join path p on p.conv_id = u.conv_id and p.d <= u.d group by p.d, p.k),
ended as (select d, k, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends from path where d = size group by d, k)
select n.conv_id, n.d::bigint as depth, a.conv_id as parent_conv_id, n.n as n_convs, n.n_children, s.n_leaves, s.saved as saved_tokens, coalesce(e.ends, sha256('')) as ends_sha256
from full_node n join subtree s using (d, k) left join ended e using (d, k) left join full_node a on a.d = n.d - 1 and a.k = n.up"""
