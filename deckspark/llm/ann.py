"""Operator 8: nearest neighbours by robust-pruned directed graphs.

Equal vectors become one node that names their smallest ids (as many as a
result can show, and one more for the query's own).  Nodes are dealt by a
hash to shards, as many as there are shuffle partitions while these hold
``SHARD_ROWS``, more beyond ``MOST_ROWS`` (every query meets every shard, so
few large ones make less work than many small ones).  A task builds each
shard's graph: nodes are inserted in growing batches, a greedy search from
the centre proposes neighbours, and pruning keeps the nearest candidate, drops
those that it is ``ALPHA`` times nearer to, and goes on with the rest; links
back are added, and a node that gathers more than ``WIDTH`` is pruned alike.
Graphs are built in single precision over vectors extended by one component
that gives all of a shard the same length, which makes distance and inner
product agree.  Every block of queries is searched by beam search in every
shard, and the shards' best are merged by exact scores of the vectors as
given.

Every vector is in the index.  A shard of at most ``EXACT_ROWS`` nodes, or a
query whose beam does not fill, is scanned instead.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component, and rows without an id, take no part; vectors meet
only vectors of their own length; repeated rows count once; if an id has
several vectors, all are candidates and its query is the first by value;
ties go to the smaller id; other columns are ignored; empty tables give no
rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import cut_lineage, file_system, own_file, shared_folder, spread

DEGREE = 32  # links that pruning leaves
WIDTH = 48  # links a node may gather before it is pruned again
BUILD_BEAM = 64
SEARCH_BEAM = 128
ALPHA = 1.2
SHARD_ROWS = 8192  # of a shard, while there are fewer shards than shuffle partitions
MOST_ROWS = 131_072  # of any shard: some 150 MB at 64 dimensions
EXACT_ROWS = 256
QUERY_BLOCK = 512
EXPAND = 4  # nodes a query expands per step


class Graph:
    """Directed graph over the rows of ``x``; ``links`` holds -1 for none."""

    def __init__(self, x: np.ndarray, links: np.ndarray | None = None):
        self.x, self.norm = x, np.einsum("ij,ij->i", x, x)
        self.centre = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
        if links is None:
            links = np.full((len(x), WIDTH), -1, np.int32)
            self.links = links
            self._build()
        self.links = links

    def beam(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, squared distances up to the query's own length) of the
        nearest nodes that greedy search finds, nearest first; -1 for none."""
        b = len(q)
        ids = np.full((b, width), -1, np.int32)
        dist = np.full((b, width), np.inf, np.float32)
        open_ = np.zeros((b, width), bool)
        seen = np.zeros((b, len(self.x)), bool)
        ids[:, 0], open_[:, 0] = self.centre, True
        dist[:, 0] = self.norm[self.centre] - 2 * (q @ self.x[self.centre])
        seen[:, self.centre] = True
        rows = np.arange(b)[:, None]
        while True:
            pick = np.where(open_, dist, np.inf)
            k = min(EXPAND, width)
            at = np.argpartition(pick, k - 1, axis=1)[:, :k]
            ready = np.isfinite(pick[rows, at])
            live = ready.any(axis=1)
            if not live.any():
                break
            open_[rows, at] = False
            nodes = np.where(ready, ids[rows, at], -1)
            near = np.where((nodes >= 0)[:, :, None], self.links[nodes], -1).reshape(b, -1)
            near[(near >= 0) & seen[rows, near]] = -1
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            new = near >= 0
            used = new.any(axis=0)
            near, new = near[:, used], new[:, used]
            if not near.shape[1]:
                continue
            r, c = np.nonzero(new)
            n = near[r, c]
            seen[r, n] = True
            d = np.full(near.shape, np.inf, np.float32)
            d[r, c] = self.norm[n] - 2 * np.einsum("ij,ij->i", q[r], self.x[n])
            ids, dist, open_ = np.hstack([ids, near]), np.hstack([dist, d]), np.hstack([open_, new])
            best = np.argpartition(dist, width - 1, axis=1)[:, :width]
            ids, dist, open_ = ids[rows, best], dist[rows, best], open_[rows, best]
        order = np.argsort(dist, axis=1, kind="stable")
        ids, dist = ids[rows, order], dist[rows, order]
        ids[~np.isfinite(dist)] = -1
        return ids, dist

    def prune(self, p: np.ndarray, cand: np.ndarray) -> np.ndarray:
        """The kept neighbours of nodes ``p`` among ``cand`` (-1 for none)."""
        cand = np.where(cand == p[:, None], -1, cand)
        x = self.x[cand]
        d = ((x - self.x[p][:, None, :]) ** 2).sum(axis=2)
        d[cand < 0] = np.inf
        out = np.full((len(p), WIDTH), -1, np.int32)
        rows, alive = np.arange(len(p)), d.copy()
        for k in range(DEGREE):
            best = alive.argmin(axis=1)
            ok = np.isfinite(alive[rows, best])
            if not ok.any():
                break
            out[ok, k] = cand[rows, best][ok]
            to = ((x - x[rows, best][:, None, :]) ** 2).sum(axis=2)
            alive[(ALPHA**2 * to <= d) | (cand == cand[rows, best][:, None])] = np.inf
        return out

    def _build(self) -> None:
        n = len(self.x)
        order = np.random.default_rng(7).permutation(n)
        order = np.concatenate([[self.centre], order[order != self.centre]])
        done = 1
        while done < n:
            p = order[done : done + min(done, 512)]
            ids, _ = self.beam(self.x[p], min(BUILD_BEAM, max(8, done)))
            self.links[p] = self.prune(p, ids)
            self._back(p)
            done += len(p)
        self._reach_all()

    def reached(self) -> np.ndarray:
        """Which nodes a walk from the centre can reach."""
        seen = np.zeros(len(self.x), bool)
        front = np.array([self.centre])
        while len(front):
            seen[front] = True
            near = np.unique(self.links[front])
            front = near[near >= 0]
            front = front[~seen[front]]
        return seen

    def _reach_all(self) -> None:
        """A link to every node that pruning has cut off, from the nearest
        reached node with room for it."""
        lost = np.flatnonzero(~self.reached())
        while len(lost):
            found, _ = self.beam(self.x[lost], BUILD_BEAM)
            for p, near in zip(lost, found):
                near = near[near >= 0]
                room = near[self.links[near, -1] < 0]
                at = room[0] if len(room) else near[0]
                free = np.flatnonzero(self.links[at] < 0)
                self.links[at, free[0] if len(free) else -1] = p
            now = np.flatnonzero(~self.reached())
            if len(now) >= len(lost):  # full lists only: searches that miss scan instead
                break
            lost = now

    def _back(self, p: np.ndarray) -> None:
        """Links back to ``p`` from its neighbours, pruned where too many."""
        src, col = np.nonzero(self.links[p] >= 0)
        to, frm = self.links[p][src, col], p[src]
        d = ((self.x[to] - self.x[frm]) ** 2).sum(axis=1)
        order = np.lexsort((d, to))
        to, frm = to[order], frm[order]
        nodes, start, count = np.unique(to, return_index=True, return_counts=True)
        most = int(min(count.max(), 2 * DEGREE))  # the nearest come first
        at = start[:, None] + np.arange(most)
        inside = np.arange(most) < count[:, None]
        new = np.where(inside, frm[np.minimum(at, len(frm) - 1)], -1)
        old = self.links[nodes]
        new[(new[:, :, None] == old[:, None, :]).any(axis=2)] = -1
        both = np.hstack([old, new])
        full = (both >= 0).sum(axis=1) > WIDTH
        fits = both[~full]
        order = np.argsort(fits < 0, axis=1, kind="stable")
        self.links[nodes[~full]] = np.take_along_axis(fits, order, axis=1)[:, :WIDTH]
        if full.any():
            self.links[nodes[full]] = self.prune(nodes[full], both[full])


def extended(x: np.ndarray) -> np.ndarray:
    """Rows of equal length, in single precision and to a common scale: one
    more component makes up the difference."""
    x = x.astype(np.float64) / np.abs(x).max()
    length = (x**2).sum(axis=1)
    return np.column_stack([x, np.sqrt(np.maximum(length.max() - length, 0))]).astype(np.float32)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>, dim) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(id_col).isNotNull() & ok).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.size(v).alias("dim"))


def _write(folder: str, arrays: dict[str, np.ndarray]) -> str:
    fs, path, uri = own_file(folder, ".npz")
    with fs.open_output_stream(path, compression=None) as f:
        np.savez(f, **arrays)
    return uri


def _load(uri: str) -> dict[str, np.ndarray]:
    fs, path = file_system(uri)
    with fs.open_input_file(path) as f, np.load(f) as z:
        return {k: z[k] for k in z.files}


def build_index(rows: DataFrame, k: int, folder: str, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Manifest (dim, shard, path, n) of the shards' graphs over the written
    table ``rows`` (vec_id, v, dim)."""
    first = Window.partitionBy("dim", "v").orderBy("vec_id")
    # limited per task before the shuffle: a vector that many rows share
    # sends only its smallest ids on
    few = rows.distinct().withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    nodes = cut_lineage(few.groupBy("dim", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "ann-nodes")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards_of = lambda n: max(1, min(tasks, math.ceil(n / shard_rows)), math.ceil(n / MOST_ROWS))
    sizes = {r["dim"]: shards_of(r["n"]) for r in nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return rows.sparkSession.createDataFrame([], "dim int, shard int, path string, n long")
    shards = F.create_map(*[F.lit(x).cast("int") for kv in sizes.items() for x in kv])

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        table = table.take(pa.compute.sort_indices(pa.compute.list_element(table.column("ids"), 0)))
        dim, n = table.column("dim")[0].as_py(), table.num_rows
        x = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, dim)
        ids = table.column("ids").combine_chunks()
        member = ids.flatten().to_numpy(zero_copy_only=False)
        start = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
        links = Graph(extended(x)).links if n > EXACT_ROWS else np.zeros((0, WIDTH), np.int32)
        path = _write(folder, {"x": x, "links": links, "member": member, "start": start})
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": table.column("shard").slice(0, 1), "path": [path], "n": pa.array([n], pa.int64())})

    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), shards[F.col("dim")]).cast("int"))
    built = dealt.select("dim", "shard", "v", "ids").groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, path string, n long")
    return cut_lineage(built, "ann-index")


def search_shard(index: dict, graph: Graph | None, ids: np.ndarray, q: np.ndarray, k: int) -> tuple:
    """(query id, vec id, score) arrays of each query's best in one shard."""
    x = index["x"]
    if graph is None:
        found = np.tile(np.arange(len(x)), (len(q), 1))
    else:
        scaled = q / np.abs(q).max(axis=1, keepdims=True)  # the order of nearness stays
        found, _ = graph.beam(np.column_stack([scaled, np.zeros(len(q))]).astype(np.float32), SEARCH_BEAM)
    out = []
    for i in range(len(q)):
        nodes = found[i][found[i] >= 0]
        if len(nodes) < min(len(x), SEARCH_BEAM):
            nodes = np.arange(len(x))
        score = x[nodes] @ q[i]
        if len(nodes) > k + 1:  # ties with the last stay
            keep = score >= np.partition(score, len(score) - k - 1)[len(score) - k - 1]
            nodes, score = nodes[keep], score[keep]
        s, e = index["start"][nodes], index["start"][nodes + 1]
        vec = np.concatenate([index["member"][a:b] for a, b in zip(s, e)])
        score = np.repeat(score, e - s)
        other = vec != ids[i]
        vec, score = vec[other], score[other]
        best = np.lexsort((vec, -score))[:k]
        out.append((np.full(len(best), ids[i]), vec[best], score[best]))
    return tuple(np.concatenate(c) for c in zip(*out))


def nearest(vectors: DataFrame, queries, k: int = 20, id_col: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` that the
    condition ``queries`` (on its ``vec_id``) names, its ``k`` best found."""
    spark = vectors.sparkSession
    folder = shared_folder(spark, "ann")
    rows = cut_lineage(usable(vectors, id_col, vector), "ann-vectors")
    index = build_index(rows, k, folder, shard_rows)
    asked = rows.where(queries).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("q")).select("vec_id", "q.dim", "q.v")
    blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("vec_id")
        dim, n = table.column("dim")[0].as_py(), table.num_rows
        q = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, dim)
        path = _write(folder, {"ids": table.column("vec_id").to_numpy(), "q": q})
        return pa.table({"dim": pa.array([dim], pa.int32()), "queries": [path]})

    packed = cut_lineage(asked.groupBy("dim", "block").applyInArrow(pack, "dim int, queries string"), "ann-queries")

    def search(batches):
        held: tuple = ("", None, None)
        for b in batches:
            for path, block in zip(b.column("path").to_pylist(), b.column("queries").to_pylist()):
                if held[0] != path:
                    shard = _load(path)
                    held = (path, shard, Graph(extended(shard["x"]), shard["links"]) if len(shard["links"]) else None)
                asked = _load(block)
                cols = search_shard(held[1], held[2], asked["ids"], asked["q"], k)
                kinds = (pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["query_id", "vec_id", "score"])

    pairs = spread(index.select("dim", "path").join(packed, "dim").select("path", "queries"), "path", "queries").sortWithinPartitions("path")
    found = pairs.mapInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
