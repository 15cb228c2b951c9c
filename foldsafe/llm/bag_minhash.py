"""Near duplicates by weighted Jaccard similarity of word shingles, with BagMinHash signatures.

A document is the bag of its five-word shingles.  For every shingle, its weight
axis is cut at 0, 1, 2, 4, 8, ...; each interval below the weight runs a Poisson
process whose rate is the interval's length, every point falling on a signature
slot and a place of the interval by hash, and counting only below the weight.  The
first point of a slot names its value: two bags agree there with probability equal
to their weighted Jaccard similarity.  Points are only made up to the time by
which all slots are likely met, so a long bag costs about one draw per shingle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foldsafe.llm.common import components, empty_text, mix, shingle_hashes, written

_U = np.uint64
_ARRIVAL, _SLOT, _PLACE, _INTERVAL = (_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
BANDS, ROWS = 21, 3
# Members of a block, at most about.
BLOCK = 512
# Codes' places looked up at once.
GATHERED = 1 << 22
# Shingles whose processes run together.
TOGETHER = 1 << 18


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((x >> _U(11)).astype(np.float64) + 1) * 2.0 ** -53


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in order and how often each occurs."""
    return np.unique(shingle_hashes(text), return_counts=True)


def bag_signatures(bags: list[tuple[np.ndarray, np.ndarray]], slots: int) -> np.ndarray:
    """The BagMinHash signatures, a row each, of bags that aren't empty; all bags' processes run together."""
    owner = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
    shingles, weights = (np.concatenate([b[i] for b in bags]) for i in (0, 1))
    units = [(owner, shingles, np.ones(len(owner)), np.zeros(len(owner)), weights)]
    i, floor = 1, 1
    while len(more := np.flatnonzero(weights > floor)):
        start = np.full(len(more), float(floor))
        units.append((owner[more], mix(shingles[more] + _U(i * int(_INTERVAL) & (1 << 64) - 1)), start, start, weights[more]))
        i, floor = i + 1, 2 * floor
    owner, seeds, length, low, weight = (np.concatenate(x) for x in zip(*units))
    until = slots * (np.log(slots) + 4) / np.array([b[1].sum() for b in bags])
    out, met = np.zeros(len(bags) * slots, _U), np.zeros(len(bags) * slots, bool)
    todo = np.ones(len(bags), bool)
    while todo.any():
        live = np.flatnonzero(todo[owner])
        time, points, turn = np.zeros(len(live)), [], 0
        while len(live):
            draw = mix(seeds[live] + _U((turn * int(_ARRIVAL) + 1) & (2 ** 64 - 1)))
            time = time - np.log(_uniform(draw)) / length[live]
            early = np.flatnonzero(time <= until[owner[live]])
            live, time, draw = live[early], time[early], draw[early]
            place = low[live] + length[live] * (1 - _uniform(mix(draw ^ _PLACE)))
            counts = np.flatnonzero(place < weight[live])
            kept = draw[counts]
            slot = (mix(kept ^ _SLOT) % _U(slots)).astype(np.int64)
            points.append((time[counts], owner[live[counts]] * slots + slot, kept))
            turn += 1
        times, at, names = (np.concatenate(x) for x in zip(*points))
        order = np.argsort(-times, kind="stable")
        out[at[order]] = names[order]  # the last to be written is the first point
        met[at] = True
        todo = ~met.reshape(-1, slots).all(1)
        until = until * 2
    return out.reshape(-1, slots)


def signature(shingles: np.ndarray, weights: np.ndarray, slots: int) -> np.ndarray:
    return bag_signatures([(shingles, weights)], slots)[0]


def band_keys(values: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """The band keys of signatures, a row each."""
    out = np.broadcast_to(np.arange(bands, dtype=_U), (len(values), bands))
    for r in range(rows):
        out = mix(out * _INTERVAL + values[:, r: bands * rows: rows])
    return out.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags; 0 if both are empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum()) + int(b[1].sum()) - shared
    return shared / total if total else 0.0


def _digest(b: tuple[np.ndarray, np.ndarray]) -> str:
    return hashlib.blake2b(b[0].tobytes() + b[1].astype("<i8").tobytes(), digest_size=16).hexdigest()


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, digest`` of the bag and its band keys; an empty bag has neither."""
    def keyed(ids: list, bags: list):
        full = [i for i, b in enumerate(bags) if len(b[0])]
        keys: list = [None] * len(bags)
        if full:
            for i, k in zip(full, band_keys(bag_signatures([bags[i] for i in full], BANDS * ROWS))):
                keys[i] = k
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([_digest(b) if len(b[0]) else None for b in bags], pa.string()),
                                           pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "digest", "bands"])

    def run(batches):
        ids, bags, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc)
                bags.append(bag(text.as_py()))
                size += len(bags[-1][0])
                if size >= TOGETHER:
                    yield keyed(ids, bags)
                    ids, bags, size = [], [], 0
        if ids:
            yield keyed(ids, bags)

    return docs.mapInArrow(run, "doc_id long, digest string, bands array<long>")


def _with_digest(batches):
    for batch in batches:
        digests = [_digest(bag(t)) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.string()), batch.column(1)], ["doc_id", "digest", "text"])


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose bags reach the threshold."""
    def run(batches):
        last: tuple = (None, None)
        for batch in batches:
            a, b, ta, tb = (c.to_pylist() for c in batch.columns)
            kept = []
            for i in range(len(a)):
                if last[0] != b[i]:
                    last = (b[i], bag(tb[i]))
                if similarity(bag(ta[i]), last[1]) >= threshold - 1e-12:
                    kept.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in kept], pa.int64()),
                                              pa.array([b[i] for i in kept], pa.int64())], ["a", "b"])

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _codes(text: str) -> np.ndarray:
    """A code for each shingle and count of it so far, so that two bags share as many codes as they share weight."""
    shingles, weights = bag(text)
    nth = np.arange(weights.sum()) - np.repeat(np.cumsum(weights) - weights, weights)
    return np.repeat(shingles, weights) + nth.astype(_U) * _INTERVAL


def _ties(nodes: np.ndarray, component: np.ndarray, main: int, codes: list[np.ndarray], left: np.ndarray, right: np.ndarray,
          threshold: float) -> list[tuple[int, int]]:
    """Links of ``threshold`` that tie the components of the rows ``left`` to those of the rows ``right``.

    A left row is counted against all right rows at once, by lists of the right rows
    that have a code.  Rows that earlier links have tied, by whatever way, are passed over.
    """
    size = np.array([len(c) for c in codes])
    ids = np.unique(np.concatenate(codes), return_inverse=True)[1]
    ids = np.split(ids, np.cumsum(size)[:-1])
    has = np.concatenate([ids[r] for r in right])
    owner = np.repeat(np.arange(len(right)), size[right])[np.argsort(has, kind="stable")]
    ends = np.cumsum(np.bincount(has, minlength=max(int(i.max()) for i in ids) + 1))
    starts = np.append(0, ends[:-1])
    # a pair outside the main component is looked at once, from its lesser node
    upper, least = np.where(component[right] == main, np.iinfo(np.int64).max, nodes[right]), threshold - 1e-12
    tied, out = component.copy(), []
    for row in left:
        mine, theirs = size[row], size[right]
        wanted = (tied[right] != tied[row]) & (upper > nodes[row]) & (np.minimum(mine, theirs) >= least * np.maximum(mine, theirs))
        if not wanted.any():
            continue
        shared = np.zeros(len(right), np.int64)
        for part in np.array_split(ids[row], mine * len(right) // GATHERED + 1):
            n = ends[part] - starts[part]
            at = np.repeat(starts[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            shared += np.bincount(owner[at], minlength=len(right))
        found = right[np.flatnonzero(wanted & (shared / (mine + theirs - shared) >= least))]
        others, first = np.unique(tied[found], return_index=True)
        out += [(int(nodes[row]), int(nodes[o])) for o in found[first]]
        tied[np.isin(tied, others)] = tied[row]
    return out


def _rest(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Verified pairs of ``members`` (key, node, component) that share a key and differ in component.

    Only members outside a key's largest component are compared with the others,
    in pairs of blocks of at most about BLOCK members, so the work follows the open
    pairs and no task holds a whole key.  What a pair of blocks has tied is passed over
    in it.  A member that is on both sides of a pair of blocks is sent to it once.
    """
    sizes = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("n"))
    # a table of its own, so that the join below can split a hot key
    main = main.select("key", F.col("main.component").alias("main"), (F.floor((F.col("n") - 1) / BLOCK) + 1).alias("blocks"),
                       (F.floor((F.col("n") - F.col("main.n") - 1) / BLOCK) + 1).alias("outer_blocks"))
    m = members.join(written(main, "open-sizes"), "key").join(texts, "node")
    outer = F.col("component") != F.col("main")
    every = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    own = lambda c: F.pmod(F.xxhash64("node"), F.col(c))
    pair = lambda i, j, left, right: F.struct(i.alias("i"), j.alias("j"), left.alias("left"), right.alias("right"))
    pairs = F.concat(F.transform(every("outer_blocks"), lambda i: pair(i, own("blocks"), outer & (i == own("outer_blocks")), F.lit(True))),
                     F.transform(F.filter(every("blocks"), lambda j: outer & (j != own("blocks"))),
                                 lambda j: pair(own("outer_blocks"), j, F.lit(True), F.lit(False))))

    def run(group: pa.Table) -> pa.Table:
        left, right = (np.flatnonzero(group.column(c).to_numpy()) for c in ("left", "right"))
        found = []
        if len(left) and len(right):
            codes = [_codes(t.as_py()) for t in group.column("text")]
            found = _ties(group.column("node").to_numpy(), group.column("component").to_numpy(), group.column("main")[0].as_py(), codes, left, right, threshold)
        return pa.table([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    sent = m.select("key", "node", "component", "main", "text", F.explode(pairs).alias("pair"))
    return sent.select("key", "node", "component", "main", "text", "pair.*").groupBy("key", "i", "j").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``doc_id, class_id``: one row per doc_id, the class being the least doc_id tied to it by links of ``threshold`` or more.

    Equal bags are one node.  In every band bucket all nodes are verified against
    the least one; where several components stay in a bucket, the open pairs are
    verified too, so no candidate link is lost.  A text of one to four words is one
    shingle; texts without a word (null, empty) are each a class of their own.  Rows
    that repeat a doc_id are one document, with the links of all of its texts, which
    it ties to each other; rows with a null doc_id are left out; other columns are
    ignored.
    """
    d = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), empty_text().alias("text"))
    s = written(signatures(d), "signatures")
    # a node is a bag: 64 bits of its digest; the least document with it lends its text
    node = F.conv(F.substring("digest", 1, 16), 16, -10).cast("long")
    full = s.where("digest is not null").withColumn("node", node)
    nodes = written(full.groupBy("node").agg(F.min(F.struct("doc_id", "digest", "bands")).alias("head")).select("node", "head.*"), "nodes")
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    pivots = keyed.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # written, so that the join can split a hot key
    shared = written(keyed.join(written(pivots, "pivots"), "key"), "buckets")
    stars = written(shared.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(), "stars")
    wanted = stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct().join(nodes.select("node", "doc_id", "digest"), "node")
    texts = written(d.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(_with_digest, "doc_id long, digest string, text string")
                    .join(wanted, ["doc_id", "digest"]).groupBy("node").agg(F.min("text").alias("text")), "texts")
    links = written(_verified(stars, texts, threshold), "links")
    tied = written(components(links, "components"), "tied")
    own = F.coalesce("component", "node")
    open_keys = shared.where("node <> pivot").join(tied, "node", "left").select("key", "node", own.alias("component"))
    several = open_keys.groupBy("key").agg(F.min("component").alias("l"), F.max("component").alias("h"),
                                          F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("all"), F.count(F.lit(1)).alias("n")).where("l <> h")
    # buckets of the same members, as bands of one group have, are looked at once
    several = written(several.groupBy("all", "n").agg(F.min("key").alias("key")).select("key"), "open-keys")
    members = written(open_keys.join(several, "key"), "open")
    more = _rest(members, texts, threshold)
    # documents of several texts tie these, whatever their likeness
    both = full.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z"), F.count(F.lit(1)).alias("n")).where("a <> z")
    both = full.join(both.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b"))
    # what is tied already goes on as one node, so that few links are left
    later = written(more.union(both), "more-links")
    if not later.isEmpty():
        one, two = (tied.select(F.col("node").alias(c), F.col("component").alias(f"{c}c")) for c in "ab")
        merged = later.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("ac", "a").alias("a"), F.coalesce("bc", "b").alias("b"))
        merged = written(components(merged, "components"), "merged").select(F.col("node").alias("component"), F.col("component").alias("over"))
        nodes_of = tied.select("node", "component").union(merged.select(F.col("component").alias("node"), "component")).distinct()
        tied = nodes_of.join(merged, "component", "left").groupBy("node").agg(F.min(F.coalesce("over", "component")).alias("component"))
    out = full.select("doc_id", "node").join(tied, "node", "left").select("doc_id", own.alias("component"))
    out = written(out.union(s.where("digest is null").select("doc_id", F.lit(None).cast("long"))), "members")
    least = out.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("class_id"))
    return out.join(written(least, "classes"), "component", "left").groupBy("doc_id").agg(F.min(F.coalesce("class_id", "doc_id")).alias("class_id"))
