"""Embedding near-dedup over a robust-pruned flat graph.

Vectors are compared only within a label. Equal vectors are collapsed to the
smallest id first, so a group of copies is one node of the graph.

1. Each label is cut into clusters around centres fitted on a bounded sample;
   every vector joins its ``overlap`` nearest clusters. Those centres are bounded in number, so a
   cluster of more than ``split_size`` vectors is cut again around centres fitted on a bounded
   sample of its own, level after level: clusters keep their size when the table grows, and a
   vector stays in the ``overlap`` nearest of all clusters it comes to. Cells whose vectors link with
   each other widely stay together; a cluster that is one such ball is not cut. Clusters of more
   than ``CAP`` vectors are dealt by a hash of the id into shards of about that size.
2. In each shard a graph is built: the nearest candidates of a node are pruned
   robustly (a candidate goes if a kept one is ``ALPHA`` times nearer to it than
   the node is), edges get their reverse, and what the medoid cannot reach is
   linked to the nearest reached node. A vector's lists from all its shards are united.
3. Every vector is searched in the shards of its clusters: greedily with a beam
   from the medoid (and from its own node in the shard that holds it), then from every node found within range to its
   neighbours, until no new one is in range. Pairs are verified in double
   precision. A pair that meets in two clusters counts in the first.
4. Recall is audited on every table: for vectors chosen by a hash, and for vectors that found a
   link, chosen in the same way, all links are counted by brute force, in blocks over all
   vectors. ``AUDIT`` vectors are drawn of each kind, then four times as many, until
   ``AUDIT_LINKED`` of those chosen by hash have a link, ``AUDIT_MOST`` or all are drawn. A label with
   ``AUDIT_LINKS`` links there passes by its own recall, the others by theirs together
   (``MIN_RECALL``; if all vectors are drawn, each label must have all its links). Where the
   others have fewer than ``AUDIT_LEAST`` links on vectors chosen by hash, that measures too
   little: they pass if twice the overlap found no more than 1 - ``MIN_RECALL`` of new links.
   Labels that do not pass are searched again with twice the overlap.
5. The vectors of labels that no overlap is enough for are compared with each other, in blocks; so
   are those of a failing label of one cluster, ``TARGET`` vectors at most.

A shard returns one row per vector (links counted, smallest vector it hangs
together with there), never its pairs; components are joined up from those.

Defined results: vectors that are null, empty, zero, or hold a null or
non-finite component, and rows with null label or id, link with nothing and are
kept; vectors of different length are never compared; repeated rows of one id
and vector are one vector; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.llm.common import connected_components, written
from verdant.operators.broadcast import broadcast_if_small

TARGET = 1500            # vectors a cluster is meant to have
CAP = 3000               # vectors a shard has, about, at most
MAX_CENTRES = 2048       # bounds the centres sent to the tasks
SAMPLE = 20_000          # bounds the vectors on which centres are fitted
SPLIT_SAMPLE = 2_560     # vectors, about, on which the centres of one cluster that is cut again are fitted
FANOUT, LEVELS = 64, 7   # bound the parts of a cluster and the times it is cut
BALL = 0.1               # share of linked pairs between two cells that keeps them together; a part with all but this share isn't cut off
CANDIDATES, DEGREE, ALPHA = 48, 24, 1.2
BEAM, WIDTH = 16, 4
RANGE_SLACK = 0.03
QUERY_BLOCK = 256
LOOK_AT = 1 << 19        # neighbours of expanded nodes that are looked at together
AUDIT, AUDIT_MOST = 256, 4096     # vectors of each kind in the first and the last audit draw; the draws go through the driver
AUDIT_LINKED = 200       # drawn vectors with a link that end the drawing
AUDIT_LINKS = 1000       # drawn links that measure a label's own recall
AUDIT_LEAST = 50         # drawn links that measure recall at all
MIN_RECALL = 0.99
OVERLAPS = (2, 4, 8)


def unit_rows(column) -> np.ndarray:
    """Rows of an Arrow list column as unit vectors in double precision."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(lists), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)      # keeps squares of tiny and huge components finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centres(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """``k`` unit centres of unit rows (spherical k-means from evenly taken rows)."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        nearest = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
    return centres


def label_centres(nodes: DataFrame, sizes: list) -> dict:
    """(label, length) -> centres, for labels of more than ``TARGET`` vectors, largest first."""
    wanted, total = {}, 0
    for row in sizes:
        k = min(-(-row["n"] // TARGET), MAX_CENTRES - total)
        if row["n"] > TARGET and k > 1:
            wanted[row["label"], row["dim"]] = k
            total += k
    if not wanted:
        return {}
    part = min(1.0, SAMPLE / max(1, sum(r["n"] for r in sizes if (r["label"], r["dim"]) in wanted)))
    chosen = nodes.where(F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) < int(part * 1_000_000)).orderBy(F.xxhash64("rep"), "rep")
    found: dict = {}
    for batch in chosen.select("label", "dim", "vector").toArrow().to_batches():
        for key, at in _by_label(batch).items():
            if key in wanted:
                found.setdefault(key, []).append(unit_rows(batch.column("vector").take(pa.array(at))))
    rows = {key: np.concatenate(found.pop(key)) for key in list(found)}
    return {key: fit_centres(x, min(wanted[key], len(x))) for key, x in rows.items()}


def _by_label(batch) -> dict:
    """(label, length) -> positions of its rows."""
    groups: dict = {}
    for k, key in enumerate(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True)):
        groups.setdefault(key, []).append(k)
    return groups


PLACES = pa.list_(pa.struct([("far", pa.float64()), ("cluster", pa.int64())]))


def _assign_batches(centres: dict, overlap: int):
    def run(batches):
        for batch in batches:
            places = [[(0.0, 0)]] * batch.num_rows
            for key, at in _by_label(batch).items():
                if key in centres:
                    far = -(unit_rows(batch.column("vector").take(pa.array(at))) @ centres[key].T)
                    take = np.argsort(far, axis=1, kind="stable")[:, :2 * overlap]
                    for k, row, value in zip(at, take.tolist(), np.take_along_axis(far, take, axis=1).tolist(), strict=True):
                        places[k] = [(f, child_code(c)) for f, c in zip(value, row, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, PLACES)], names=[*batch.schema.names, "places"])
    return run


def child_code(child: int, parent: int | None = None) -> int:
    """Number of a cluster: its level in the last four bits, its way down the levels before them."""
    return child << 4 if parent is None else ((((parent >> 4) * FANOUT + child) << 4) | ((parent & 15) + 1))


def split_size(overlap: int) -> int:
    """Vectors of a cluster from which on it is cut again: four times as many as clusters are meant to have."""
    return 4 * overlap * TARGET


def joined_cells(x: np.ndarray, centres: np.ndarray, threshold: float) -> np.ndarray:
    """Part of each centre: cells of the rows ``x`` between which a share of ``BALL`` or more of the pairs
    is linked are one part."""
    cell = np.argmax(x @ centres.T, axis=1)
    inside = np.zeros((len(x), len(centres)))
    inside[np.arange(len(x)), cell] = 1
    linked = inside.T @ ((x @ x.T >= threshold) @ inside)
    size = inside.sum(axis=0)
    u, v = np.nonzero(linked >= BALL * np.maximum(np.outer(size, size), 1))
    return np.unique(_roots(len(centres), u, v), return_inverse=True)[1]


def _fit_split(overlap: int, threshold: float):
    def run(key, table):
        """Sampled vectors of a cluster -> its centres and their parts; nothing for a cluster that is one ball."""
        n, x = table.column("n")[0].as_py(), unit_rows(table.column("vector").take(pa.array(np.argsort(table.column("rep").to_numpy()))))
        centres = fit_centres(x, min(FANOUT, max(4 * overlap, -(-n // (overlap * TARGET))), len(x)))
        part = joined_cells(x, centres, threshold)
        fullest = np.bincount(part[np.argmax(x @ centres.T, axis=1)]).max() / len(x)
        some = slice(0, 1 if fullest < 1 - BALL else 0)
        return pa.table({"label": pa.array([key[0].as_py()][some], pa.int64()), "dim": pa.array([key[1].as_py()][some], pa.int32()),
                         "cluster": pa.array([key[2].as_py()][some], pa.int64()), "n": pa.array([n][some], pa.int64()),
                         "centres": pa.array([centres.tolist()][some], pa.list_(pa.list_(pa.float64()))),
                         "part": pa.array([part.tolist()][some], pa.list_(pa.int32()))})
    return run


def _assign_split(overlap: int):
    def run(key, rows, split):
        """Vectors of a cluster -> the nearest of its parts, twice ``overlap``; a part is as near as its nearest centre."""
        centres, part = np.array(split.column("centres")[0].as_py()), np.array(split.column("part")[0].as_py())
        if not rows.num_rows:
            return pa.table({"rep": pa.array([], pa.int64()), "far": pa.array([], pa.float64()), "cluster": pa.array([], pa.int64())})
        order = np.argsort(part, kind="stable")
        starts = np.searchsorted(part[order], np.arange(part.max() + 1))
        far = np.minimum.reduceat(-(unit_rows(rows.column("vector")) @ centres[order].T), starts, axis=1)
        take = np.argsort(far, axis=1, kind="stable")[:, :2 * overlap]
        code = np.array([child_code(c, key[2].as_py()) for c in range(len(starts))], dtype=np.int64)
        return pa.table({"rep": pa.array(np.repeat(rows.column("rep").to_numpy(), take.shape[1])),
                         "far": pa.array(np.take_along_axis(far, take, axis=1).ravel()), "cluster": pa.array(code[take.ravel()])})
    return run


def cut_large(placed: DataFrame, overlap: int, threshold: float) -> DataFrame:
    """``placed`` with its large clusters cut again, level after level. The rows of a cluster are dealt out to tasks
    of about ``4 * CAP``; each gets the cluster's own centres, fitted on vectors that no other cluster is nearer to, so that the
    parts of two clusters don't cover the same ground. On the way down a vector keeps twice as many places as it has
    in the end, since the nearest part need not lie in the nearest cluster."""
    keys, n = ["label", "dim", "cluster"], F.col("n")
    nearest = placed.withColumn("places", F.slice("places", 1, overlap))
    for level in range(LEVELS):
        each = placed.select("rep", "label", "dim", "vector", F.posexplode("places").alias("pos", "p")).select(
            "rep", "label", "dim", "vector", "pos", F.col("p.far").alias("far"), F.col("p.cluster").alias("cluster"))
        large = written(nearest.select("label", "dim", F.posexplode("places.cluster").alias("pos", "cluster"))
                        .where(F.col("cluster").bitwiseAND(15) == level).groupBy(*keys)
                        .agg(F.count("*").alias("n"), F.sum(F.when(F.col("pos") == 0, 1).otherwise(0)).alias("own"))
                        .where(n > split_size(overlap)), "graph-large")
        if large.isEmpty():
            break
        drawn = (F.col("pos") == 0) & (F.pmod(F.xxhash64("rep", F.lit(level)), F.lit(1 << 30)) * F.col("own") < F.lit(SPLIT_SAMPLE * (1 << 30)))
        split = written(each.join(broadcast_if_small(large), keys).where(drawn).select(*keys, "rep", "n", "vector").groupBy(*keys).applyInArrow(
            _fit_split(overlap, threshold), "label bigint, dim int, cluster bigint, n bigint, centres array<array<double>>, part array<int>"),
            "graph-split")
        if split.isEmpty():
            break
        tasks = F.ceil(n / (4 * CAP)).cast("int")
        sizes = broadcast_if_small(split.select(*keys, "n"))
        rows = each.join(sizes, keys).select(*keys, F.pmod(F.xxhash64("rep"), tasks).cast("int").alias("deal"), "rep", "vector")
        copies = split.withColumn("deal", F.explode(F.sequence(F.lit(0), tasks - 1)))
        cut = rows.groupBy(*keys, "deal").cogroup(copies.groupBy(*keys, "deal")).applyInArrow(
            _assign_split(overlap), "rep bigint, far double, cluster bigint")
        left = each.join(sizes, keys, "left_anti").select("rep", "far", "cluster")
        places = cut.unionByName(left).groupBy("rep").agg(
            F.slice(F.sort_array(F.collect_list(F.struct("far", "cluster"))), 1, 2 * overlap).alias("places"))
        placed = written(placed.drop("places").join(places, "rep"), "graph-placed")
        nearest = placed.withColumn("places", F.slice("places", 1, overlap))
    return nearest


def medoid_of(x: np.ndarray) -> int:
    return int(np.argmax(x @ x.sum(axis=0)))


def build_graph(x: np.ndarray) -> list[np.ndarray]:
    """Neighbours of each row of unit vectors: pruned, with reverse edges, all reached from the medoid."""
    n = len(x)
    pool = min(CANDIDATES, n - 1)
    edges = []
    for a in range(0, n if pool else 0, 256):
        rows = np.arange(a, min(a + 256, n))
        near = x[rows] @ x.T
        near[np.arange(len(rows)), rows] = -2
        cand = np.argpartition(-near, pool - 1, axis=1)[:, :pool]
        sims = np.take_along_axis(near, cand, axis=1)
        order = np.argsort(-sims, axis=1, kind="stable")
        cand, sims = np.take_along_axis(cand, order, axis=1), np.take_along_axis(sims, order, axis=1)
        own = np.sqrt(np.maximum(2 - 2 * sims, 0))
        alive, kept = np.ones(cand.shape, dtype=bool), np.zeros(cand.shape, dtype=bool)
        gathered = x[cand]
        for j in range(pool):
            pick = alive[:, j] & (kept.sum(axis=1) < DEGREE)
            kept[pick, j] = True
            between = np.sqrt(np.maximum(2 - 2 * np.einsum("rd,rkd->rk", gathered[:, j], gathered), 0))
            alive &= ~(pick[:, None] & (ALPHA * between <= own))
        r, c = np.nonzero(kept)
        edges.append(np.stack([rows[r], cand[r, c]]))
    both = np.concatenate(edges, axis=1) if edges else np.zeros((2, 0), dtype=int)
    pairs = np.unique(np.concatenate([both, both[::-1]], axis=1), axis=1)
    lists = np.split(pairs[1], np.searchsorted(pairs[0], np.arange(1, n)))
    # Whatever the medoid does not reach hangs on the nearest reached node.
    reached = np.zeros(n, dtype=bool)
    front = [medoid_of(x)] if n else []
    while front:
        reached[front] = True
        while front:
            nxt = np.unique(np.concatenate([lists[i] for i in front]))
            front = nxt[~reached[nxt]].tolist()
            reached[front] = True
        if not reached.all():
            out, inside = int(np.flatnonzero(~reached)[0]), np.flatnonzero(reached)
            near = int(inside[np.argmax(x[inside] @ x[out])])
            lists[near], lists[out] = np.append(lists[near], out), np.append(lists[out], near)
            front = [out]
    return lists


def _build_shard(key, table):
    reps = table.column("rep").to_numpy()
    lists = build_graph(unit_rows(table.column("vector")))
    return pa.table({"label": pa.array([key[0].as_py()] * len(reps), pa.int64()), "rep": pa.array(reps),
                     "near": pa.array([reps[i].tolist() for i in lists], pa.list_(pa.int64()))})


def range_search(q: np.ndarray, x: np.ndarray, graph: np.ndarray, threshold: float,
                 members: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) pairs with a dot product of ``threshold`` at least that the
    graph leads to. ``graph``: neighbours of each member, filled up with -1.
    The search enters at the medoid; with ``members`` (the queries are the rows
    of ``x``) also at the query's own node."""
    n, start = len(x), medoid_of(x)
    q32, x32 = q.astype(np.float32), x.astype(np.float32)
    out_q, out_m = [], []
    for a in range(0, len(q), QUERY_BLOCK):
        own = q32[a:a + QUERY_BLOCK]
        b = len(own)
        rows = np.arange(b)
        sims = np.full((b, n), -2, dtype=np.float32)      # -2: not seen
        done = np.zeros((b, n), dtype=bool)
        sims[:, start] = own @ x32[start]
        beam = np.full((b, BEAM), -1)
        beam[:, 0] = start
        if members:
            sims[rows, a + rows] = np.einsum("bd,bd->b", own, x32[a:a + b])
            beam[:, 1] = np.where(a + rows == start, -1, a + rows)

        def look(queries, nodes, sims=sims, done=done, own=own):
            """Expand nodes for queries; returns the (query, node) pairs seen for
            the first time. A few pairs at a time: each has a row of neighbours."""
            done[queries, nodes] = True
            seen_q, seen_n, step = [], [], max(1, LOOK_AT // graph.shape[1])
            for at in range(0, len(queries), step):
                near = graph[nodes[at:at + step]]
                pair_q, node = np.repeat(queries[at:at + step], near.shape[1]), near.ravel()
                fresh = node >= 0
                pair_q, node = pair_q[fresh], node[fresh]
                fresh = sims[pair_q, node] == -2
                flat = np.unique(pair_q[fresh] * n + node[fresh])
                pair_q, node = flat // n, flat % n
                for c in range(0, len(flat), 1 << 16):
                    s = slice(c, c + (1 << 16))
                    sims[pair_q[s], node[s]] = np.einsum("pd,pd->p", own[pair_q[s]], x32[node[s]])
                seen_q.append(pair_q), seen_n.append(node)
            pair_q, node = np.concatenate(seen_q), np.concatenate(seen_n)
            order = np.argsort(pair_q, kind="stable")
            return pair_q[order], node[order]

        while True:                                       # greedy: the best of the beam not yet expanded
            safe = np.maximum(beam, 0)
            open_ = (beam >= 0) & ~done[rows[:, None], safe]
            open_ &= np.cumsum(open_, axis=1) <= WIDTH
            r, c = np.nonzero(open_)
            if not len(r):
                break
            pair_q, node = look(r, beam[r, c])
            # New nodes of each query beside its beam; the best of both stay.
            counts = np.bincount(pair_q, minlength=b)
            slot = np.arange(len(node)) - np.repeat(np.cumsum(counts) - counts, counts)
            fresh = np.full((b, int(counts.max()) if len(node) else 0), -1)
            fresh[pair_q, slot] = node
            wide = np.concatenate([beam, fresh], axis=1)
            value = np.where(wide >= 0, sims[rows[:, None], np.maximum(wide, 0)], -3)
            order = np.argsort(-value, axis=1, kind="stable")[:, :BEAM]
            beam = np.take_along_axis(wide, order, axis=1)
        while True:                                       # range expansion
            r, c = np.nonzero((sims >= threshold - RANGE_SLACK) & ~done)
            if not len(r):
                break
            look(r, c)
        r, c = np.nonzero(sims >= threshold - 1e-3)
        for at in range(0, len(r), 1 << 16):
            i, j = a + r[at:at + (1 << 16)], c[at:at + (1 << 16)]
            exact = np.einsum("pd,pd->p", q[i], x[j]) >= threshold
            out_q.append(i[exact]), out_m.append(j[exact])
    none = [np.empty(0, dtype=int)]
    return np.concatenate(none + out_q), np.concatenate(none + out_m)


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest position each position hangs together with."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, u, root[v])
        np.minimum.at(root, v, root[u])
        root = root[root]
        if np.array_equal(root, before):
            return root


def _search_shard(threshold: float):
    def run(key, table):
        """Rows of two shards of a cluster (``side`` 0: searched, 1: queries; one
        shard with itself has side 0 only) -> links and root of each vector."""
        cluster = key[1].as_py()
        side = table.column("side").to_numpy()
        table = table.take(pa.array(np.lexsort((table.column("rep").to_numpy(), side))))
        side, reps = table.column("side").to_numpy(), table.column("rep").to_numpy()
        copies, x = table.column("copies").to_numpy(), unit_rows(table.column("vector"))
        n = int((side == 0).sum())
        at = {int(r): k for k, r in enumerate(reps[:n])}
        lists = [[at[r] for r in near if r in at] for near in table.column("near").slice(0, n).to_pylist()]
        graph = np.full((n, max(map(len, lists), default=0) or 1), -1, dtype=np.int32)
        for k, near in enumerate(lists):
            graph[k, :len(near)] = near
        own = n == len(reps)
        q, m = range_search(x if own else x[n:], x[:n], graph, threshold, members=own) if n else (np.zeros(0, int),) * 2
        q = q if own else q + n
        q, m = np.minimum(q, m), np.maximum(q, m)         # a link found from either end is a link
        pairs = np.unique(np.stack([q, m])[:, q != m], axis=1)
        clusters = table.column("clusters").to_pylist()
        first = np.array([min(set(clusters[i]) & set(clusters[j])) == cluster for i, j in pairs.T], dtype=bool)
        u, v = pairs[:, first] if pairs.size else pairs
        links = np.bincount(u, weights=copies[v], minlength=len(reps)) + np.bincount(v, weights=copies[u], minlength=len(reps))
        by_rep = np.argsort(reps, kind="stable")          # positions in the order of ids: roots are smallest ids
        place = np.empty_like(by_rep)
        place[by_rep] = np.arange(len(reps))
        root = reps[by_rep][_roots(len(reps), place[u], place[v])][place]
        return pa.table({"rep": pa.array(reps), "links": pa.array(links.astype(np.int64)), "root": pa.array(root)})
    return run


def _audit_batches(x: np.ndarray, labels: list, reps: list, threshold: float):
    def run(batches):
        names, ids = np.array(labels), np.array(reps)
        total = np.zeros(len(ids), dtype=np.int64)
        for batch in batches:
            batch = batch.filter(pa.array([d == x.shape[1] for d in batch.column("dim").to_pylist()], pa.bool_()))
            if not batch.num_rows:
                continue
            rows, label, rep, copies = (unit_rows(batch.column("vector")), *(batch.column(c).to_numpy() for c in ("label", "rep", "copies")))
            for at in range(0, len(ids), QUERY_BLOCK):
                s = slice(at, at + QUERY_BLOCK)
                near = (rows @ x[s].T >= threshold) & (label[:, None] == names[s]) & (rep[:, None] != ids[s])
                total[s] += near.T @ copies
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["rep", "truth"])
    return run


def audit_truth(nodes: DataFrame, found: DataFrame, threshold: float) -> tuple[DataFrame, bool]:
    """``(rep, label, dim, by_hash, truth)`` of the vectors drawn for the audit, and whether these are all. ``found``: ``(rep, links)``.
    The vectors are sent to all tasks and compared with every vector of their label, in blocks."""
    size = AUDIT
    linked = nodes.join(found.where("links > 0").select("rep"), "rep", "left_semi")
    while True:
        first = lambda rows: rows.orderBy(F.xxhash64("rep"), "rep").limit(size + 1).select("rep", "label", "dim", "vector").toArrow()  # noqa: B023, E731
        drawn = first(nodes)
        whole, drawn = drawn.num_rows <= size, drawn.slice(0, size)
        by_hash = set(drawn.column("rep").to_pylist())
        if not whole:
            other = first(linked).slice(0, size)
            drawn = pa.concat_tables([drawn, other.filter(pa.array([r not in by_hash for r in other.column("rep").to_pylist()], pa.bool_()))])
        rep, label, dims = (drawn.column(c).to_pylist() for c in ("rep", "label", "dim"))
        truth = nodes.sparkSession.createDataFrame([], "rep bigint, truth bigint")
        for dim in sorted(set(dims)):
            own = [k for k, d in enumerate(dims) if d == dim]
            x = unit_rows(drawn.column("vector").take(pa.array(own)))
            truth = truth.unionByName(nodes.select("rep", "label", "dim", "copies", "vector").mapInArrow(
                _audit_batches(x, [label[k] for k in own], [rep[k] for k in own], threshold), "rep bigint, truth bigint"))
        kinds = nodes.sparkSession.createDataFrame([(r, name, dim, r in by_hash) for r, name, dim in zip(rep, label, dims, strict=True)],
                                                   "rep bigint, label bigint, dim int, by_hash boolean")
        truth = written(kinds.join(truth.groupBy("rep").agg(F.sum("truth").alias("truth")), "rep"), "graph-audit")
        if whole or size >= AUDIT_MOST or truth.where("by_hash and truth > 0").count() >= AUDIT_LINKED:
            return truth, whole
        size *= 4


def failing_labels(nodes: DataFrame, truth: DataFrame, whole: bool, now: DataFrame, before: DataFrame | None) -> DataFrame:
    """``(label, dim)`` of the labels of ``nodes`` that do not pass. ``now`` and ``before``: ``(rep, links)`` found with this
    and with half the overlap."""
    keys = ["label", "dim"]
    shares = truth.join(now, "rep", "left").groupBy(*keys).agg(
        F.sum("truth").alias("all"), F.sum(F.least("truth", F.coalesce("links", F.lit(0)))).alias("hit"),
        F.sum(F.when(F.col("by_hash"), F.col("truth")).otherwise(0)).alias("measured"))
    links = lambda found, name: nodes.select("rep", *keys).join(found, "rep", "left").groupBy(*keys).agg(
        F.coalesce(F.sum("links"), F.lit(0)).alias(name))
    each = links(now, "now").join(shares, keys, "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    if whole:
        return each.where(zero("hit") < zero("all")).select(*keys)
    each = each.join(links(before, "before"), keys) if before is not None else each.withColumn("before", F.lit(-1))
    alone = zero("all") >= AUDIT_LINKS
    others = each.where(~alone).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("all", "hit", "measured", "now", "before")]).first()
    passed = others["hit"] >= MIN_RECALL * others["all"] and (
        others["measured"] >= AUDIT_LEAST or (before is not None and MIN_RECALL * others["now"] <= others["before"]))
    return each.where(F.when(alone, zero("hit") < MIN_RECALL * zero("all")).otherwise(F.lit(not passed))).select(*keys)


def recall_of(truth: DataFrame, found: DataFrame) -> float:
    row = truth.join(found, "rep", "left").agg(F.sum("truth"), F.sum(F.least("truth", F.coalesce("links", F.lit(0))))).first()
    return row[1] / row[0] if row[0] else 1.0


def audit_recall(nodes: DataFrame, found: DataFrame, threshold: float) -> float:
    """Share of the links of the audit's vectors that were found (1 if they have none)."""
    return recall_of(audit_truth(nodes, found, threshold)[0], found)


def _compare_blocks(threshold: float):
    def run(key, table):
        """Rows of two blocks (``side`` 0 and 1; one block with itself has side 0
        only) -> links and root of each vector, from all pairs."""
        table = table.take(pa.array(np.argsort(table.column("rep").to_numpy(), kind="stable")))
        side, reps = table.column("side").to_numpy(), table.column("rep").to_numpy()
        copies, x = table.column("copies").to_numpy(), unit_rows(table.column("vector"))
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = not len(two)
        two = one if alone else two
        links, root = np.zeros(len(reps), dtype=np.int64), np.arange(len(reps))
        for at in range(0, len(one), QUERY_BLOCK):
            rows = one[at:at + QUERY_BLOCK]
            near = x[rows] @ x[two].T >= threshold
            if alone:
                near &= rows[:, None] < two
            r, c = np.nonzero(near)
            u, v = rows[r], two[c]
            np.add.at(links, u, copies[v])
            np.add.at(links, v, copies[u])
            if len(u):
                root = _roots(len(reps), np.concatenate([np.arange(len(reps)), u]), np.concatenate([root, v]))
        return pa.table({"rep": pa.array(reps), "links": pa.array(links), "root": pa.array(reps[root])})
    return run


def all_links(nodes: DataFrame, threshold: float) -> DataFrame:
    """``(rep, links, root)`` partial rows as of ``search_links``, from comparing all vectors of a label."""
    keys = ["label", "dim"]
    blocks = nodes.groupBy(*keys).agg(F.ceil(F.count("*") / CAP).cast("int").alias("blocks"))
    each = written(nodes.select(*keys, "rep", "copies", "vector").join(blocks, keys)
                   .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")), "graph-blocks")
    # Each pair of blocks of a label once: i <= j.
    asked = each.select(*keys, "rep", "copies", "vector", F.col("block").alias("i"),
                        F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"), F.lit(0).alias("side"))
    other = each.where("block > 0").select(*keys, "rep", "copies", "vector", F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("i"),
                                           F.col("block").alias("j"), F.lit(1).alias("side"))
    return written(asked.unionByName(other).groupBy(*keys, "i", "j")
                   .applyInArrow(_compare_blocks(threshold), "rep bigint, links bigint, root bigint"), "graph-found")


def search_links(nodes: DataFrame, sizes: list, threshold: float, overlap: int) -> DataFrame:
    """``(rep, links, root)`` partial rows of every vector and shard, written."""
    centres = label_centres(nodes, sizes)
    kind = nodes.schema["vector"].dataType.simpleString()
    fields = f"rep bigint, label bigint, dim int, copies bigint, vector {kind}, places array<struct<far: double, cluster: bigint>>"
    placed = written(nodes.select("rep", "label", "dim", "copies", "vector").mapInArrow(_assign_batches(centres, overlap), fields), "graph-placed")
    placed = cut_large(placed, overlap, threshold)
    each = placed.withColumn("clusters", F.col("places.cluster")).drop("places").withColumn("cluster", F.explode("clusters"))
    shards = each.groupBy("label", "dim", "cluster").agg(F.ceil(F.count("*") / CAP).cast("int").alias("shards"))
    keys = ["label", "cluster", "dim"]
    each = written(each.join(shards, keys).withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int")), "graph-shards")
    lists = each.groupBy("label", "cluster", "shard", "dim").applyInArrow(_build_shard, "label bigint, rep bigint, near array<bigint>")
    # A vector's lists from all its shards together.
    united = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    members = written(each.join(united, "rep"), "graph-lists")
    # Each pair of shards of a cluster once; a shard alone, in the usual case.
    upto = F.sequence(F.lit(0), F.col("shard"))
    after = F.when(F.col("shard") + 1 < F.col("shards"), F.sequence(F.col("shard") + 1, F.col("shards") - 1)).otherwise(F.array().cast("array<int>"))
    columns = [*keys, "rep", "copies", "vector", "clusters"]
    searched = members.select(*columns, "near", F.col("shard").alias("to"), F.explode(upto).alias("from"), F.lit(0).alias("side"))
    asking = members.select(*columns, F.lit(None).cast("array<bigint>").alias("near"), F.explode(after).alias("to"),
                            F.col("shard").alias("from"), F.lit(1).alias("side"))
    return written(searched.unionByName(asking).groupBy("label", "cluster", "to", "from", "dim")
                   .applyInArrow(_search_shard(threshold), "rep bigint, links bigint, root bigint"), "graph-found")


def near_duplicate_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                           label_col: str = "label", threshold: float = 0.93) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``: vectors of one label with a
    cosine of ``threshold`` or more are linked, and the smallest id of a component is kept."""
    kind = "float" if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else "double"
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                          F.col(f"`{vector_col}`").cast(f"array<{kind}>").alias("vector"))
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    sound = F.coalesce(finite & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    keyed = written(rows.withColumn("sound", sound).withColumn("key", F.when(F.col("sound"), F.sha2(F.concat_ws(
        ",", F.col("label").cast("string"), F.transform("vector", lambda x: (x + F.lit(0.0).cast(kind)).cast("string"))), 256))), "graph-rows")
    nodes = written(keyed.where("sound").dropDuplicates(["key", "vec_id"]).groupBy("key")
                    .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"),
                         F.first("vector").alias("vector")).withColumn("dim", F.size("vector")), "graph-nodes")
    total = lambda found: written(found.groupBy("rep").agg(F.sum("links").alias("links")), "graph-links")
    keys, found, open_nodes, before = ["label", "dim"], None, nodes, None
    for overlap in OVERLAPS:
        counts = open_nodes.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > TARGET)
        sizes = counts.orderBy(F.desc("n"), *keys).limit(MAX_CENTRES).collect()
        tried = search_links(open_nodes, sizes, threshold, overlap)
        now = total(tried)
        truth, whole = audit_truth(open_nodes, now, threshold)
        failing = written(failing_labels(open_nodes, truth, whole, now, before), "graph-failing")
        passed = tried.join(open_nodes.join(failing, keys, "left_anti").select("rep"), "rep", "left_semi")
        found = passed if found is None else found.unionByName(passed)
        again = open_nodes.join(failing, keys, "left_semi")
        # More overlap changes nothing for a label of one cluster.
        more = counts.select(*keys) if overlap != OVERLAPS[-1] else counts.select(*keys).limit(0)
        found = found.unionByName(all_links(again.join(more, keys, "left_anti"), threshold))
        open_nodes, before = written(again.join(more, keys, "left_semi"), "graph-again"), now
        if open_nodes.isEmpty():
            break
    found = written(found, "graph-all")
    links = total(found)
    components = connected_components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    per_node = (nodes.select("key", "rep", "copies").join(links, "rep", "left")
                .join(components.select(F.col("node").alias("rep"), "component"), "rep", "left")
                .select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                        F.coalesce("component", "rep").alias("component")))
    return (keyed.select("vec_id", "key").join(per_node, "key", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


ORACLE = """
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
u AS MATERIALIZED (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93 AND a.n > 0 AND b.n > 0),
reach AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.c = links.a),
comp AS (SELECT vec_id, min(c) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)
"""
