"""Conversation prefix trie by union-find over sorted neighbours.

Conversations become binary keys, a fixed number of bytes a turn, and are sorted by
key.  Two neighbours share as many turns as their keys share tokens (their LCP).
Taken in descending depth, these edges grow components: where an edge of depth ``d``
merges two components, the common prefix of ``d`` turns is a branching node, and the
turns between it and the tops of the two components are nodes with one child each.

Every range partition grows its own forest.  A prefix of the partition's first or last
conversation may go on in a neighbour, so such nodes stay open: the forest is
contracted to its first and last conversation, with what hangs from each of their
prefixes summed up.  Contracted forests of neighbouring partitions are merged by the
same union-find, ``FAN`` at a time, until one is left.  Only two rows a partition ever
meet in a merge, whatever the number of conversations below a node.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import materialise

#: Bytes of a turn in a key: MD5 of role and text, then the text's UTF-8 length.
TOKEN = 20
#: Turns (with their conversations) a range partition should hold.
PARTITION_TURNS = 400_000
#: Contracted forests merged in one task.
FAN = 64
#: Ids written as one piece of a long list.
PIECE_IDS = 50_000
NOBODY = np.iinfo(np.int64).max


@dataclass(slots=True)
class Node:
    """What is known of a prefix: members, the smallest of them, children already
    closed, and of these children the leaves and saved bytes of their subtrees."""

    n: int = 0
    least: int = NOBODY
    children: int = 0
    leaves: int = 0
    saved: int = 0

    def add(self, o: Node) -> None:
        self.n += o.n
        self.least = min(self.least, o.least)
        self.children += o.children
        self.leaves += o.leaves
        self.saved += o.saved


def lcp(a: bytes, b: bytes) -> int:
    """Whole tokens two keys share at their start."""
    m = min(len(a), len(b))
    if a[:m] == b[:m]:
        return m // TOKEN
    if m <= 32 * TOKEN:
        d = 0
        while a[d:d + TOKEN] == b[d:d + TOKEN]:
            d += TOKEN
        return d // TOKEN
    return int((np.frombuffer(a, np.uint8, m) != np.frombuffer(b, np.uint8, m)).argmax()) // TOKEN


def prefix_id(key: bytes, depth: int) -> bytes:
    return hashlib.md5(key[:depth * TOKEN]).digest()


def last_size(key: bytes, depth: int) -> int:
    """UTF-8 bytes of the last text of a prefix (the root has none)."""
    return int.from_bytes(key[depth * TOKEN - 4:depth * TOKEN], "big") if depth else 0


class Forest:
    """Union-find over conversations in key order.

    ``hung[i]`` holds, by depth, what is already known of the prefixes of conversation
    ``i``; a conversation itself is a member at its full depth.  A block that is not
    ``whole`` may go on at both ends: prefixes of its first and last conversation stay
    open, and ``hung`` of these two is what is left of them when it has grown.
    """

    def __init__(self, keys: list[bytes], hung: list[dict[int, Node]], whole: bool):
        n = len(keys)
        self.keys, self.hung, self.whole, self.last = keys, hung, whole, n - 1
        self.up, self.low, self.high = list(range(n)), list(range(n)), list(range(n))
        self.top = [len(k) // TOKEN for k in keys]
        self.node = [h.pop(t, None) or Node() for h, t in zip(hung, self.top)]
        self.below: list[list[int]] = [[] for _ in keys]        # closed children of the top node
        #: item with this prefix (the one that ends here, if any does), depth, node, parent
        #: (place in this list, or prefix id of an open node)
        self.closed: list[list] = []

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def _close(self, c: int) -> int:
        place = len(self.closed)
        self.closed.append([self.low[c], self.top[c], self.node[c], None])
        for child in self.below[c]:
            self.closed[child][3] = place
        return place

    def _hang(self, c: int) -> None:
        v, d = self.node[c], self.top[c]
        if v.n or v.children:
            self.hung[c][d] = v
        if self.below[c]:
            name = prefix_id(self.keys[c], d)
            for child in self.below[c]:
                self.closed[child][3] = name

    def lift(self, c: int, depth: int) -> None:
        """Move the top of component ``c`` up to ``depth``: nodes passed are closed, or
        hung up if the component may go on outside the block."""
        is_open = not self.whole and (self.low[c] == 0 or self.high[c] == self.last)
        while self.top[c] > depth:
            d, v = self.top[c], self.node[c]
            above = self.hung[c].pop(d - 1, None) or Node()
            if is_open:
                self._hang(c)
                self.below[c] = []
            else:
                self.below[c] = [self._close(c)]
                above.add(Node(v.n, v.least, 1, v.leaves if v.children else 1, v.saved + (v.n - 1) * last_size(self.keys[c], d)))
            self.node[c], self.top[c] = above, d - 1

    def _merge(self, a: int, b: int, depth: int) -> None:
        """Join neighbours ``a`` and ``b`` in a node of ``depth`` turns.  The first and the
        last item of an open block stay the names of their components."""
        self.lift(a, depth)
        self.lift(b, depth)
        keep, go = (b, a) if not self.whole and b == self.last and a != 0 else (a, b)
        self.node[keep].add(self.node[go])
        self.below[keep] += self.below[go]
        mine, theirs = self.hung[keep], self.hung[go]
        for d in [d for d in theirs if d < depth]:              # deeper ones are the last item's own
            if d in mine:
                mine[d].add(theirs.pop(d))
            else:
                mine[d] = theirs.pop(d)
        self.low[keep], self.high[keep] = self.low[a], self.high[b]
        self.up[go] = keep

    def grow(self) -> Forest:
        edges = np.array([lcp(a, b) for a, b in zip(self.keys, self.keys[1:])], np.int64)
        for e in np.argsort(-edges, kind="stable").tolist():
            self._merge(self.find(e), self.find(e + 1), int(edges[e]))
        root = self.find(0)
        self.lift(root, 0)
        if self.whole:
            self._close(root)
        else:
            self._hang(root)
        return self

    def nodes(self) -> Iterator[dict]:
        for item, depth, v, parent in self.closed:
            known = isinstance(parent, int)
            yield {"kind": "n", "item": item, "conv_id": v.least, "depth": depth, "parent_conv_id": self.closed[parent][2].least if known else None,
                   "parent": None if known else parent, "n_convs": v.n, "n_children": v.children, "n_leaves": v.leaves if v.children else 1,
                   "saved_tokens": v.saved + (v.n - 1) * last_size(self.keys[item], depth)}

    def contracted(self) -> list[tuple[bytes, dict[int, Node]]]:
        ends = [0] if self.keys[0] == self.keys[self.last] else [0, self.last]
        return [(self.keys[i], self.hung[i]) for i in ends]


def _pack(hung: dict[int, Node]) -> bytes:
    return np.array([(d, v.n, v.least, v.children, v.leaves, v.saved) for d, v in sorted(hung.items())], np.int64).tobytes()


def _unpack(data: bytes) -> dict[int, Node]:
    return {int(d): Node(*map(int, v)) for d, *v in np.frombuffer(data, np.int64).reshape(-1, 6)}


#: Rows of a step: nodes (kind n), pieces of id lists that may go on elsewhere (i), contracted forests (f).
ROWS = ("kind string, conv_id long, depth int, parent_conv_id long, parent binary, prefix binary, n_convs long, n_children long,"
        " n_leaves long, saved_tokens long, ends_sha256 string, block long, place int, data binary")
_ARROW = pa.schema([("kind", pa.string()), ("conv_id", pa.int64()), ("depth", pa.int32()), ("parent_conv_id", pa.int64()), ("parent", pa.binary()),
                    ("prefix", pa.binary()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                    ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("block", pa.int64()), ("place", pa.int32()), ("data", pa.binary())])


def _batches(rows: Iterator[dict], size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)


def _joined(ids: array) -> bytes:
    return ",".join(map(str, ids)).encode()


def _first_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of one range partition (sorted by key, then id)."""
    keys: list[bytes] = []
    starts, ids = array("q"), array("q")
    for b in batches:
        for key, i in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist()):
            if not keys or key != keys[-1]:
                keys.append(key)
                starts.append(len(ids))
            ids.append(i)
    if not keys:
        return
    starts.append(len(ids))
    block = TaskContext.get().partitionId()

    def rows() -> Iterator[dict]:
        for j, k in enumerate(keys):                     # id lists of open prefixes may go on in other blocks
            if keys[0].startswith(k) or keys[-1].startswith(k):
                name = prefix_id(k, len(k) // TOKEN)
                for place, at in enumerate(range(starts[j], starts[j + 1], PIECE_IDS)):
                    yield {"kind": "i", "prefix": name, "block": block, "place": place,
                           "data": _joined(ids[at:min(at + PIECE_IDS, starts[j + 1])])}
        f = Forest(keys, [{len(k) // TOKEN: Node(starts[j + 1] - starts[j], ids[starts[j]])} for j, k in enumerate(keys)], False).grow()
        for node in f.nodes():
            j = node.pop("item")
            ends = len(keys[j]) == node["depth"] * TOKEN
            yield node | {"ends_sha256": hashlib.sha256(_joined(ids[starts[j]:starts[j + 1]]) if ends else b"").hexdigest()}
        for place, (key, hung) in enumerate(f.contracted()):
            yield {"kind": "f", "prefix": key, "block": block, "place": place, "data": _pack(hung)}

    yield from _batches(rows())


def _merged_forest(fan: int, whole: bool):
    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["block", "place", "prefix", "data"]).to_pylist(), key=lambda r: (r["block"], r["place"]))
        f = Forest([r["prefix"] for r in rows], [_unpack(r["data"]) for r in rows], whole).grow()
        out = []
        for node in f.nodes():
            key = f.keys[node.pop("item")]
            out.append(node | {"prefix": prefix_id(key, node["depth"])})
        if not whole:
            out += [{"kind": "f", "prefix": key, "block": rows[0]["block"] // fan, "place": place, "data": _pack(hung)}
                    for place, (key, hung) in enumerate(f.contracted())]
        return pa.Table.from_pylist(out, schema=_ARROW)
    return merge


def _list_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of every id list, its pieces in order; one piece is held at a time."""
    name, digest = None, None
    for b in batches:
        names, shas = [], []
        for prefix, data in zip(b.column("prefix").to_pylist(), b.column("data").to_pylist()):
            if prefix != name:
                if digest is not None:
                    names.append(name)
                    shas.append(digest.hexdigest())
                name, digest = prefix, hashlib.sha256(data)
            else:
                digest.update(b"," + data)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(shas, pa.string())], names=["prefix", "sha"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([digest.hexdigest()], pa.string())], names=["prefix", "sha"])


def conversation_keys(turns: DataFrame, id_column: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id`` and ``key`` of every conversation: the tokens of its turns, by ``order``
    (null first; ties by role, then by the text's digest).

    Null roles and texts count as empty; rows without an id are left out; repeated rows
    are repeated turns; other columns are not looked at.  Texts of any length become 20
    bytes, and only these are gathered: a conversation is one value, so its turns (not
    its texts) must fit in a task.
    """
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    token = F.concat(F.unhex(F.md5(F.concat(F.length(r).cast("string"), F.lit(":"), r, t))), F.unhex(F.lpad(F.hex(F.octet_length(t)), 8, "0")))
    rows = turns.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("conv_id"), F.col(order).alias("o"), r.alias("r"), token.alias("t"))
    whole = F.array_sort(F.collect_list(F.struct(F.col("o").isNotNull().alias("late"), "o", "r", "t")))
    return rows.groupBy("conv_id").agg(F.unhex(F.array_join(F.transform(whole, lambda x: F.hex(x["t"])), "")).alias("key"))


def spliced(keys: DataFrame, base: Column, turns: Column) -> DataFrame:
    """Every conversation with its first ``turns`` turns replaced by those of conversation
    ``base`` (all, if it has fewer; none, if it is absent)."""
    own = keys.select("conv_id", "key", base.alias("base"), (turns * TOKEN).cast("int").alias("cut"))
    others = keys.select(F.col("conv_id").alias("base"), F.col("key").alias("head"))
    head = F.coalesce(F.substring(F.col("head"), F.lit(1), F.col("cut")), F.lit(b""))
    rest = F.substring(F.col("key"), F.col("cut") + 1, F.lit(2 ** 31 - 1))
    return own.join(others, "base", "left").select("conv_id", F.concat(head, rest).alias("key"))


def trie(keys: DataFrame, fan: int = FAN, partitions: int | None = None) -> DataFrame:
    """All nodes of the prefix trie of conversations (``conv_id``, ``key``; see
    :func:`conversation_keys`).

    A node is a distinct sequence of ``depth`` turns, from the root (depth 0) on; its
    members are the conversations that start with it.  Columns: ``conv_id`` (smallest
    member; with the depth it names the node), ``depth``, ``parent_conv_id`` (null at the
    root), ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes of the
    subtree), ``saved_tokens`` (over the subtree, members but one times the bytes of the
    last text), ``ends_sha256`` (of the ids that end here, ascending, comma-joined).

    Keys that are alike share all nodes; empty keys are members of the root only; an
    empty table gives no node; null ids and keys are left out; ids must be unique.  Range
    partitions hold about ``PARTITION_TURNS`` turns whatever the input's size, and equal
    keys may lie in several of them.  Lists of ids that cross partitions are hashed in
    one pass each, piece by piece, as the digest asks for.
    """
    spark = keys.sparkSession
    keys = materialise(keys.where("conv_id IS NOT NULL AND key IS NOT NULL").select("conv_id", "key"), "trie-keys")
    if partitions is None:
        size = keys.agg(F.coalesce(F.sum(F.length("key").cast("long") / TOKEN + 1), F.lit(0)).alias("n")).first().n
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size // PARTITION_TURNS) + 1)
    ordered = keys.repartitionByRange(partitions, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    level = materialise(ordered.mapInArrow(_first_forest, ROWS), "trie")
    inner = level.where("kind = 'n'")
    pieces = level.where("kind = 'i'").select("prefix", "block", "place", "data")
    lists = pieces.repartition("prefix").sortWithinPartitions("prefix", "block", "place").mapInArrow(_list_digests, "prefix binary, sha string")
    blocks, upper = partitions, None
    while blocks > 1 or upper is None:
        blocks = -(-blocks // fan)
        forests = level.where("kind = 'f'").groupBy(F.floor(F.col("block") / fan)).applyInArrow(_merged_forest(fan, blocks == 1), ROWS)
        level = materialise(forests, "trie")
        found = level.where("kind = 'n'")
        upper = found if upper is None else upper.unionByName(found)
    upper = materialise(upper.drop("ends_sha256").join(lists, "prefix", "left").withColumn(
        "ends_sha256", F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest()))), "trie-upper")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    both = inner.select(*columns, "parent").unionByName(upper.select(*columns, "parent"))
    # Only children of nodes that crossed partitions still look for their parent; both sides
    # are plain shuffles, so adaptive execution can split the children of a wide node.
    above = upper.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("above"))
    late = both.where("parent IS NOT NULL").join(above, "parent").withColumn("parent_conv_id", F.col("above"))
    out = both.where("parent IS NULL").select(*columns).unionByName(late.select(*columns))
    return out.withColumn("depth", F.col("depth").cast("long"))
