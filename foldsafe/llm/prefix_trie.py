"""Prefix tree of conversations, as double-array tries of prefix shards.

A conversation is a sequence of turns.  Equal conversations are one sequence with a
weight.  A prefix that more than SHARD_TURNS turns of distinct sequences lie under is
an upper node; a shard holds whole subtrees below upper nodes and is of bounded size.
In a shard, turns get dense ids, the sequences are packed into BASE and CHECK
arrays (a child of state s by turn t is the cell BASE[s] + t, if CHECK there is s),
and walking these gives each node's counts.  Upper nodes, which shards share, get
the sums of the shards' tops and of their own.

Turns and prefixes are told apart by 128-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foldsafe.llm.common import mix, written

_U = np.uint64
_STEP_1, _STEP_2 = _U(0xD6E8FEB86659FD93), _U(0x9E3779B97F4A7C15)
GROUP, MAX_HEAD = 100, 5
SHARD_TURNS = 1 << 16
# Conversation ids that a chunk of a node's list holds.
CHUNK_IDS = 1 << 13
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns in order, each as two hashes of role and text and the text's code points."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    d = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    hashes = F.xxhash64("role", "text"), F.xxhash64(F.lit("again"), "text", "role")
    # sorted by these fields in turn, nulls first
    one = F.struct("turn", F.substring("role", 1, 64).alias("role"), F.substring("text", 1, 256).alias("text"), hashes[0].alias("x"), hashes[1].alias("y"),
                   F.length("text").alias("n"))
    d = d.select("conv_id", one.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return d.select("conv_id", F.transform("t", lambda t: F.struct(t["x"].alias("x"), t["y"].alias("y"), t["n"].cast("long").alias("n"))).alias("turns"))


def rebuilt(turns: DataFrame, group: int = GROUP) -> DataFrame:
    """``conv_id, turns``: the first h turns of the group's first conversation, then the own ones after the first h."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(MAX_HEAD + 1)).cast("int")
    heads = turns.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, MAX_HEAD).alias("head"))
    d = turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).withColumn("h", h).join(heads, "base", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast(dict(turns.dtypes)["turns"]))
    return d.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def _ragged(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bounds and field arrays of a list<struct> column."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.flatten()
    return offsets - offsets[0], [np.asarray(c) for c in flat.flatten()]


def prefix_hashes(bounds: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the prefix that ends at each turn."""
    first, second = np.empty(len(x), _U), np.empty(len(x), _U)
    size = np.diff(bounds)
    live = np.flatnonzero(size > 0)
    a, b = np.zeros(len(live), _U), np.full(len(live), _STEP_2)
    depth = 0
    while len(live):
        at = bounds[live] + depth
        a, b = mix(a * _STEP_1 + x[at]), mix(b * _STEP_2 + y[at])
        first[at], second[at] = a, b
        depth += 1
        more = size[live] > depth
        live, a, b = live[more], a[more], b[more]
    return first, second


def _with_prefixes(d: DataFrame) -> DataFrame:
    """Every turn of ``conv_id, turns`` with the hashes ``p, q`` of the prefix it ends."""
    turn = "struct<x:bigint,y:bigint,n:bigint,p:bigint,q:bigint>"

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            bounds, (x, y, n) = _ragged(column)
            p, q = prefix_hashes(bounds, x.view(_U), y.view(_U))
            fields = [pa.array(v) for v in (x, y, n, p.view(np.int64), q.view(np.int64))]
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.StructArray.from_arrays(fields, list("xynpq")))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["conv_id", "turns"])

    return d.mapInArrow(run, f"conv_id long, turns array<{turn}>")


class DoubleArray:
    """BASE and CHECK arrays over dense symbols; state 0 is the top."""

    def __init__(self, symbols: int):
        self.base, self.check = np.zeros(max(symbols, 16) * 2, np.int64), np.full(max(symbols, 16) * 2, -1, np.int64)
        self.check[0] = 0
        self.free = 1  # no cell below is free
        self.end = 1   # no cell from here on is used

    def _room(self, n: int) -> None:
        if n > len(self.check):
            more = max(n, 2 * len(self.check)) - len(self.check)
            self.base, self.check = np.concatenate([self.base, np.zeros(more, np.int64)]), np.concatenate([self.check, np.full(more, -1, np.int64)])

    def add(self, state: int, symbols: np.ndarray) -> np.ndarray:
        """Give ``state`` children by sorted distinct symbols; their cells."""
        while self.free < self.end and self.check[self.free] >= 0:
            self.free += 1
        # the first free cells that the least symbol can take; the rest of the row must be free too
        tries, at = 0, self.free
        while True:
            if at >= self.end or tries == 8:
                base = self.end - int(symbols[0])
                break
            base = at - int(symbols[0])
            self._room(base + int(symbols[-1]) + 1)
            if (self.check[base + symbols] < 0).all():
                break
            tries, at = tries + 1, at + 1
            while at < self.end and self.check[at] >= 0:
                at += 1
        self._room(base + int(symbols[-1]) + 1)
        cells = base + symbols
        self.base[state], self.check[cells] = base, state
        self.end = max(self.end, int(cells[-1]) + 1)
        return cells

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children of states by symbols, or -1."""
        cells = self.base[states] + symbols
        inside = (cells > 0) & (cells < len(self.check))
        cells = np.where(inside, cells, 0)
        return np.where(inside & (self.check[cells] == states) & (cells != 0), cells, -1)


def pack(bounds: np.ndarray, symbols: np.ndarray, n_symbols: int) -> DoubleArray:
    """The trie of sequences of dense symbols, level by level."""
    trie, size = DoubleArray(n_symbols), np.diff(bounds)
    live = np.flatnonzero(size > 0)
    state, depth = np.zeros(len(live), np.int64), 0
    while len(live):
        symbol = symbols[bounds[live] + depth]
        pairs, which = np.unique(np.stack([state, symbol], 1), axis=0, return_inverse=True)
        cuts = np.flatnonzero(np.diff(pairs[:, 0], prepend=-1))
        cells = np.concatenate([trie.add(int(pairs[a, 0]), pairs[a:b, 1]) for a, b in zip(cuts, [*cuts[1:], len(pairs)])])
        state, depth = cells[which.ravel()], depth + 1
        more = size[live] > depth
        live, state = live[more], state[more]
    return trie


def _shard(table: pa.Table) -> pa.Table:
    """The nodes of a shard's sequences ``skip, turns, weight, least``, whose first ``skip`` turns are upper nodes."""
    column = table.column("turns").combine_chunks()
    bounds, (x, y, n, p, q) = _ragged(column)
    skip, weight, least = (table.column(c).to_numpy() for c in ("skip", "weight", "least"))
    start, size = bounds[:-1] + skip, np.diff(bounds) - skip
    own = np.concatenate([np.arange(a, a + m) for a, m in zip(start, size)])
    inner = np.concatenate([[0], np.cumsum(size)])
    # the first turn of a subtree is its prefix, so that subtrees below several upper nodes stay apart
    top = np.zeros(len(own), bool)
    top[inner[:-1]] = True
    keys = np.stack([np.where(top, p[own], x[own]), np.where(top, q[own], y[own]), top.astype(np.int64)], 1)
    names, symbols = np.unique(keys, axis=0, return_inverse=True)
    symbols = symbols.ravel().astype(np.int64)
    trie = pack(inner, symbols, len(names))
    cells = len(trie.check)
    count, first, ends = np.zeros(cells, np.int64), np.full(cells, np.iinfo(np.int64).max), np.zeros(cells, bool)
    place, depth_of = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
    live, state, depth, levels = np.arange(len(size)), np.zeros(len(size), np.int64), 0, []
    while len(live):
        at = inner[live] + depth
        state = trie.step(state, symbols[at])
        assert (state >= 0).all()
        np.add.at(count, state, weight[live])
        np.minimum.at(first, state, least[live])
        place[state], depth_of[state] = own[at], skip[live] + depth + 1
        levels.append(np.unique(state))
        depth += 1
        more = size[live] > depth
        live, state = live[more], state[more]
    children, leaves, saved = np.zeros(cells, np.int64), np.zeros(cells, np.int64), np.zeros(cells, np.int64)
    for level in reversed(levels):
        leaves[level] = np.where(children[level] == 0, 1, leaves[level])
        saved[level] += (count[level] - 1) * n[place[level]]
        above = trie.check[level]
        np.add.at(children, above, 1)
        np.add.at(leaves, above, leaves[level])
        np.add.at(saved, above, saved[level])
    nodes = np.concatenate(levels)
    above = trie.check[nodes]
    parent = pa.array(first[above], mask=above == 0)
    cols = [p[place[nodes]], q[place[nodes]], first[nodes], depth_of[nodes], parent, count[nodes], children[nodes], leaves[nodes], saved[nodes]]
    out = {name: pa.array(c) for name, c in zip(("p", "q", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), cols)}
    # the upper nodes above a subtree's top, from the tree's top on
    path = [None] * len(nodes)
    owner = np.searchsorted(bounds, place[nodes], "right") - 1
    for i in np.flatnonzero(above == 0):
        a, m = bounds[owner[i]], int(depth_of[nodes[i]]) - 1
        path[i] = [{"p": 0, "q": 0}, *({"p": int(u), "q": int(v)} for u, v in zip(p[a: a + m], q[a: a + m]))]
    out["above"] = pa.array(path, pa.list_(pa.struct([("p", pa.int64()), ("q", pa.int64())])))
    return pa.table(out)


_NODES = ("p long, q long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, above array<struct<p:bigint,q:bigint>>")


def joined_ids(d: DataFrame, chunk: int = CHUNK_IDS) -> DataFrame:
    """``p, q, ends_sha256`` of the conversation ids that end at a node, in order.

    Ids are sorted by ranges, so many tasks share a node; chunks of the list follow
    each other through one running digest, which holds one chunk at a time.
    """
    def chunks(batches):
        node, first, ids = None, None, []

        def row():
            return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([ids[0]], pa.int64()),
                                               pa.array([",".join(map(str, ids))])], ["p", "q", "first", "list"])
        for batch in batches:
            for p, q, i in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and ((p, q) != node or len(ids) == chunk):
                    yield row()
                    ids = []
                node = (p, q)
                ids.append(i)
        if ids:
            yield row()

    def digests(batches):
        node, digest, rows = None, None, []
        for batch in batches:
            for p, q, _, part in zip(*(c.to_pylist() for c in batch.columns)):
                if node != (p, q):
                    if node:
                        rows.append((*node, digest.hexdigest()))
                    node, digest = (p, q), hashlib.sha256(part.encode())
                else:
                    digest.update(b"," + part.encode())
            if len(rows) > 10_000:
                yield batch_of(rows)
                rows = []
        if node:
            yield batch_of([*rows, (*node, digest.hexdigest())])

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))], ["p", "q", "ends_sha256"])

    n = max(int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = d.repartitionByRange(n, "p", "q", "conv_id").sortWithinPartitions("p", "q", "conv_id")
    lists = ranged.mapInArrow(chunks, "p long, q long, first long, list string")
    return lists.repartition("p", "q").sortWithinPartitions("p", "q", "first").mapInArrow(digests, "p long, q long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the prefix tree of rebuilt conversations.

    Columns: conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.  Turns go by ``turn`` (null
    first); equal ones by the starts of role (64) and text (256), then their hashes.  Null role or text is
    empty.  Rows with a null conv_id take no part; repeated rows are turns of their
    own; other columns are ignored; no conversation gives no node.  A conversation's
    turns are one row of 40 bytes a turn in one task, its texts are not.
    """
    d = written(_with_prefixes(rebuilt(written(turns_of(conversations), "turns"))), "rebuilt")
    size = F.size("turns")
    last = F.when(size > 0, F.element_at("turns", F.when(size > 0, size).otherwise(1)))
    node = [F.coalesce(last[c], F.lit(0)).alias(f"e{c}") for c in "pq"]  # the top is 0, 0
    d = d.select("conv_id", *node, "turns")
    # equal conversations meet as partial sums
    distinct = d.groupBy("ep", "eq").agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("least"), F.min("turns").alias("turns"))
    distinct = written(distinct, "sequences")
    under = distinct.select(F.size("turns").alias("size"), F.posexplode("turns")).select(
        F.col("col.p").alias("p"), F.col("col.q").alias("q"), (F.col("size") - F.col("pos")).cast("long").alias("turns"))
    upper = under.groupBy("p", "q").agg(F.sum("turns").alias("turns")).where(F.col("turns") > shard_turns).select("p", "q")
    upper = written(upper, "upper")
    deep = (distinct.select("ep", "eq", F.posexplode("turns")).select("ep", "eq", (F.col("pos") + 1).alias("skip"), F.col("col.p").alias("p"), F.col("col.q").alias("q"))
            .join(upper, ["p", "q"]).groupBy("ep", "eq").agg(F.max("skip").alias("skip")))
    distinct = written(distinct.join(deep, ["ep", "eq"], "left").withColumn("skip", F.coalesce("skip", F.lit(0))), "placed")
    inside = distinct.where(F.size("turns") > F.col("skip"))
    total = inside.agg(F.sum(F.size("turns") - F.col("skip"))).first()[0] or 0
    shards = max(-(-total // shard_turns), 1)
    top = F.element_at("turns", F.col("skip") + 1)
    shard = F.pmod(F.xxhash64(top["p"], top["q"]), F.lit(shards))
    nodes = (inside.select(shard.alias("shard"), "skip", "turns", "weight", "least").groupBy("shard").applyInArrow(_shard, _NODES))
    nodes = written(nodes, "nodes")

    # upper nodes: what the subtrees' tops and the conversations that end there bring to all above
    tops = nodes.where("above is not null")
    zero = F.lit(0).cast("long")
    none = F.struct(zero.alias("p"), zero.alias("q"))
    brought = tops.select(F.posexplode("above").alias("depth", "node"), (F.size("above") - 1).alias("own"), "n_convs", "conv_id", "n_leaves", "saved_tokens")
    brought = brought.select("node.p", "node.q", F.col("depth").cast("long").alias("depth"), "n_convs", "conv_id", "n_leaves", "saved_tokens",
                             (F.col("depth") == F.col("own")).cast("long").alias("n_children"))
    ended = distinct.where(F.size("turns") <= F.col("skip"))
    path = F.concat(F.array(none), F.transform("turns", lambda t: F.struct(t["p"].alias("p"), t["q"].alias("q"))))
    ended = ended.select(F.posexplode(path).alias("depth", "node"), "weight", "least").select(
        "node.p", "node.q", F.col("depth").cast("long").alias("depth"), F.col("weight").alias("n_convs"), F.col("least").alias("conv_id"), zero.alias("n_leaves"),
        zero.alias("saved_tokens"), zero.alias("n_children"))
    sums = brought.union(ended).groupBy("p", "q", "depth").agg(
        *[F.sum(c).alias(c) for c in ("n_convs", "n_leaves", "saved_tokens", "n_children")], F.min("conv_id").alias("conv_id"))
    # each upper node's way up and last text, from any sequence through it
    through = distinct.where("skip > 0").select("skip", "turns").withColumn("d", F.explode(F.sequence(F.lit(1), F.col("skip"))))
    at = F.element_at("turns", F.col("d"))
    through = through.select(at["p"].alias("p"), at["q"].alias("q"), at["n"].alias("n"), F.slice("turns", F.lit(1), F.col("d") - 1).alias("t"))
    through = through.groupBy("p", "q").agg(F.min("n").alias("n"), F.min("t").alias("t")).select(
        "p", "q", "n", F.concat(F.array(none), F.transform("t", lambda t: F.struct(t["p"].alias("p"), t["q"].alias("q")))).alias("way"))
    upper = written(sums.join(through, ["p", "q"], "left"), "upper-nodes")
    own = (F.col("n_convs") - 1) * F.col("n")
    up = upper.where("way is not null").select(F.explode(F.concat("way", F.array(F.struct("p", "q")))).alias("node"), own.alias("own"))
    up = up.select("node.p", "node.q", "own").groupBy("p", "q").agg(F.sum("own").alias("own"))
    parent = F.element_at("way", -1)
    added = upper.where("way is not null").groupBy(parent["p"].alias("p"), parent["q"].alias("q")).agg(F.count(F.lit(1)).alias("more"))
    names = upper.select(F.col("p").alias("ap"), F.col("q").alias("aq"), F.col("conv_id").alias("above_conv"))
    full = upper.join(up, ["p", "q"], "left").join(added, ["p", "q"], "left").withColumn("ap", parent["p"]).withColumn("aq", parent["q"]).join(names, ["ap", "aq"], "left")
    children = F.col("n_children") + F.coalesce("more", zero)
    full = full.select("p", "q", "conv_id", "depth", F.col("above_conv").alias("parent_conv_id"), "n_convs", children.alias("n_children"),
                       F.when(children == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")).alias("n_leaves"),
                       (F.col("saved_tokens") + F.coalesce("own", zero)).alias("saved_tokens"))
    columns = full.columns
    above = F.element_at("above", -1)
    joined = tops.withColumn("ap", above["p"]).withColumn("aq", above["q"]).join(names, ["ap", "aq"]).withColumn("parent_conv_id", F.col("above_conv"))
    every = nodes.where("above is null").select(columns).union(joined.select(columns)).union(full.select(columns))
    ends = joined_ids(written(d.select(F.col("ep").alias("p"), F.col("eq").alias("q"), "conv_id"), "ends"))
    return every.join(ends, ["p", "q"], "left").select(*columns[2:], F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))


def oracle() -> str:
    """DuckDB SQL: every prefix of every rebuilt conversation, grouped plainly; crc32 by its table."""
    shift = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
    return f"""WITH crc AS (SELECT list(list_reduce(range(8), lambda v, j: {shift}, i::BIGINT) ORDER BY i) AS t FROM range(256) r(i)),
own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, turns, conv_id - conv_id % {GROUP} AS base, xor(4294967295::BIGINT, list_reduce(
    list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT)) % {MAX_HEAD + 1} AS h FROM own, crc),
full_ AS (SELECT h.conv_id, list_concat(coalesce(b.turns[1 : h], []), h.turns[h + 1 :]) AS turns FROM h LEFT JOIN own b ON b.conv_id = base),
member AS (SELECT conv_id, depth, turns[1 : depth] AS path, len(turns) = depth AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM full_)),
node AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM member GROUP BY path, depth),
child AS (SELECT path[1 : depth - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
counted AS (SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child USING (path)),
under AS (SELECT path[1 : up] AS path, sum((n_children = 0)::BIGINT) AS n_leaves,
    sum(CASE WHEN depth > 0 THEN (n_convs - 1) * length(path[depth]['t']) ELSE 0 END) AS saved_tokens
  FROM (SELECT path, depth, n_children, n_convs, unnest(range(0, depth + 1)) AS up FROM counted) GROUP BY 1)
SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c JOIN under u ON u.path = c.path LEFT JOIN counted p ON c.depth > 0 AND p.depth = c.depth - 1 AND p.path = c.path[1 : c.depth - 1]"""
