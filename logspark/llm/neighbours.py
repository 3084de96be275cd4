"""Nearest neighbours by a robust-pruned directed graph in each shard, searched with beams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from logspark.llm.common import saved

SHARD_ROWS = 4096
BLOCK_QUERIES = 1024
DEGREE = 24
BUILD_BEAM = 40
SEARCH_BEAM = 96
RELAX = 1.2
BATCH = 256
# vectors that are smaller than the largest by more than this are compared in double precision
NARROW = 1e-6


def squares(vectors: np.ndarray, near: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``to`` to the vectors that ``near`` names for it."""
    gap = vectors[near] - to[:, None, :]
    return np.einsum("ijk,ijk->ij", gap, gap)


def comparable(*groups: np.ndarray) -> list[np.ndarray]:
    """The vectors in one scale in which squares neither overflow nor vanish: divided by the largest component of all,
    in single precision unless the vectors' own sizes lie too far apart for it."""
    sizes = np.concatenate([np.abs(g).max(1) for g in groups])
    scale = sizes.max()
    kind = np.float32 if sizes.min() > scale * NARROW else np.float64
    return [(g / scale).astype(kind) for g in groups]


def beam_search(vectors: np.ndarray, graph: np.ndarray, entry: int, to: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best ``beam`` nodes (or as many as found; -1 behind) for each row of ``to``, by greedy walks, all rows at once."""
    rows, n = len(to), len(vectors)
    beam = min(beam, n)
    seen = np.zeros((rows, n + 1), bool)
    seen[:, entry] = seen[:, n] = True
    ids = np.full((rows, beam), n, np.int64)
    dist = np.full((rows, beam), np.inf, vectors.dtype)
    done = np.ones((rows, beam), bool)
    ids[:, 0], done[:, 0] = entry, False
    dist[:, 0] = squares(vectors, ids[:, :1], to)[:, 0]
    alive = np.arange(rows)
    while len(alive):
        best = np.argmax(~done[alive], axis=1)  # the beam is sorted: the first open node is the nearest
        open_ = ~done[alive, best]
        alive, best = alive[open_], best[open_]
        if not len(alive):
            break
        done[alive, best] = True
        near = graph[ids[alive, best]]
        fresh = ~seen[alive[:, None], near]
        seen[alive[:, None], near] = True
        away = squares(vectors, np.where(fresh, near, 0), to[alive])
        away[~fresh] = np.inf
        all_ids = np.concatenate((ids[alive], near), 1)
        all_dist = np.concatenate((dist[alive], away), 1)
        all_done = np.concatenate((done[alive], ~fresh), 1)
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids[alive] = np.take_along_axis(all_ids, order, 1)
        dist[alive] = np.take_along_axis(all_dist, order, 1)
        done[alive] = np.take_along_axis(all_done, order, 1) | np.isinf(dist[alive])
    return np.where(np.isinf(dist), -1, ids), dist


def robust_prune(vectors: np.ndarray, owners: np.ndarray, candidates: np.ndarray, relax: float) -> np.ndarray:
    """Diverse neighbours of each owner: the nearest candidate stays and removes all that it is much nearer to than the owner.

    ``candidates`` has -1 where there is none, and no candidate twice in a row of it.
    """
    n = len(vectors)
    bad = (candidates < 0) | (candidates == owners[:, None])
    safe = np.where(bad, 0, candidates)
    points = vectors[safe]
    away = np.where(bad, np.inf, squares(vectors, safe, vectors[owners]))
    norms = np.einsum("ijk,ijk->ij", points, points)
    between = norms[:, :, None] + norms[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
    kept = np.full((len(owners), DEGREE), n, np.int64)
    rows = np.arange(len(owners))
    left = away.copy()
    for k in range(DEGREE):
        best = np.argmin(left, axis=1)
        some = np.isfinite(left[rows, best])
        if not some.any():
            break
        kept[some, k] = safe[rows, best][some]
        close = relax * relax * between[rows, best] <= away
        left[close] = np.inf
        left[rows, best] = np.inf
    return kept


def without_repeats(ids: np.ndarray) -> np.ndarray:
    """Rows with each id once; -1 in place of the others."""
    order = np.sort(ids, axis=1)
    order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
    return order


def build_graph(vectors: np.ndarray) -> tuple[np.ndarray, int]:
    """(graph, entry): row i of ``graph`` has the neighbours of vector i, filled up with ``len(vectors)``.

    Starts from random edges; points, in batches, search the graph so far, choose neighbours by robust pruning, first
    strict and then relaxed, and give edges back to those they chose, which are pruned again if they have too many.
    """
    n = len(vectors)
    rng = np.random.default_rng(5)
    entry = int(np.argmin(((vectors - vectors.mean(0)) ** 2).sum(1)))
    if n <= DEGREE + 1:
        full = np.tile(np.arange(n), (n, 1))
        full[np.arange(n), np.arange(n)] = n
        return np.pad(full, ((0, 1), (0, max(0, DEGREE - n))), constant_values=n)[:, : max(DEGREE, n)], entry
    graph = rng.integers(0, n, (n + 1, DEGREE))
    graph[n] = n
    for relax in (1.0, RELAX):
        for batch in np.array_split(rng.permutation(n), -(-n // BATCH)):
            found, _ = beam_search(vectors, graph, entry, vectors[batch], BUILD_BEAM)
            old = np.where(graph[batch] == n, -1, graph[batch])
            graph[batch] = robust_prune(vectors, batch, without_repeats(np.concatenate((found, old), 1)), relax)
            source = np.repeat(batch, DEGREE)
            target = graph[batch].ravel()
            source, target = source[target < n], target[target < n]
            order = np.argsort(target, kind="stable")
            source, target = source[order], target[order]
            if not len(target):
                continue
            heads, first, sizes = np.unique(target, return_index=True, return_counts=True)
            # back edges in rounds of at most DEGREE a node, so that a popular node's rows stay short
            spot = np.arange(len(target)) - np.repeat(first, sizes)
            for low in range(0, int(sizes.max()), DEGREE):
                part = (spot >= low) & (spot < low + DEGREE)
                nodes, at = np.unique(target[part], return_inverse=True)
                extra = np.full((len(nodes), DEGREE), -1)
                extra[at, spot[part] - low] = source[part]
                now = np.where(graph[nodes] == n, -1, graph[nodes])
                merged = without_repeats(np.concatenate((now, extra), 1))
                count = (merged >= 0).sum(1)
                few = count <= DEGREE
                tight = -np.sort(-merged[few], axis=1)[:, :DEGREE]
                graph[nodes[few]] = np.where(tight < 0, n, tight)
                if (~few).any():
                    graph[nodes[~few]] = robust_prune(vectors, nodes[~few], merged[~few], relax)
    return graph, entry


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec, dim) of vectors that are neither null, empty nor zero, and have finite components only; ids not null."""
    vec = F.col(vector_col).cast("array<double>")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    picked = rows.select(F.col(id_col).cast("bigint").alias("id"), vec.alias("vec")).where("id IS NOT NULL AND size(vec) > 0")
    return picked.where(~bad & F.exists("vec", lambda x: x != 0)).withColumn("dim", F.size("vec"))


def search(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of each row of ``queries``, its own id left out.

    Distances are Euclidean, in double precision on the given vectors; ties go to the smaller id. Equal vectors are one
    node of the graph, which stands for its k + 1 smallest ids, so copies crowd no shard. Vectors of another length than
    the query's are no candidates. Rows that repeat id and vector count once. Fewer candidates than ``k``: all.
    Shards are filled by the hash of the vector, about SHARD_ROWS nodes each; queries visit every shard in blocks.
    """
    valid = usable(rows, id_col, vector_col)
    copies = Window.partitionBy("mark", "vec").orderBy("id")
    marked = valid.dropDuplicates(["id", "vec"]).withColumn("mark", F.xxhash64("vec")).withColumn("nth", F.row_number().over(copies))
    nodes = saved(marked.where(F.col("nth") <= k + 1), "ann-nodes")
    first = nodes.where("nth = 1")
    shards = max(1, -(-first.count() // SHARD_ROWS))
    first = first.withColumn("shard", F.pmod("mark", F.lit(shards)).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        flat = table["vec"].combine_chunks().flatten().to_numpy()
        vectors = flat.reshape(table.num_rows, -1)
        ids = table["id"].to_numpy()
        order = np.argsort(ids)
        vectors, ids = vectors[order], ids[order]
        graph, entry = build_graph(comparable(vectors)[0])
        row = {
            "shard": table["shard"][:1].combine_chunks(), "dim": table["dim"][:1].combine_chunks(), "entry": pa.array([entry], pa.int32()),
            "width": pa.array([graph.shape[1]], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()),
            "vectors": pa.array([vectors.tobytes()], pa.binary()), "graph": pa.array([graph.astype(np.int32).tobytes()], pa.binary()),
        }
        return pa.table(row)

    schema = "shard int, dim int, entry int, width int, ids binary, vectors binary, graph binary"
    index = saved(first.select("shard", "dim", "id", "vec").groupBy("shard", "dim").applyInArrow(build, schema), "ann-index")
    asked = usable(queries, id_col, vector_col).dropDuplicates(["id", "vec"])
    asked = saved(asked, "ann-queries")
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).cast("int"))
    sent = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select("shard", "dim", "block", "id", "vec")
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def visit(key, queries: pa.Table, shard: pa.Table) -> pa.Table:
        out = {"query_id": [], "node": [], "score": []}
        if queries.num_rows and shard.num_rows:
            one = {n: shard[n][0].as_py() for n in ("dim", "entry", "width", "ids", "vectors", "graph")}
            vectors = np.frombuffer(one["vectors"]).reshape(-1, one["dim"])
            graph = np.frombuffer(one["graph"], np.int32).reshape(-1, one["width"])
            ids = np.frombuffer(one["ids"], np.int64)
            flat = queries["vec"].combine_chunks().flatten().to_numpy().reshape(-1, one["dim"])
            scaled, asked = comparable(vectors, flat)
            for part in np.array_split(np.arange(len(flat)), -(-len(flat) // BATCH)):
                found, _ = beam_search(scaled, graph, one["entry"], asked[part], max(SEARCH_BEAM, 2 * k))
                exact = np.sqrt(squares(vectors, np.maximum(found, 0), flat[part]))
                exact[found < 0] = np.inf
                nearest = np.lexsort((ids[np.maximum(found, 0)], exact), axis=1)[:, : k + 1]
                for row, q in enumerate(part):
                    good = [i for i in nearest[row] if found[row, i] >= 0]
                    out["query_id"] += [queries["id"][int(q)].as_py()] * len(good)
                    out["node"] += ids[found[row, good]].tolist()
                    out["score"] += exact[row, good].tolist()
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "node": pa.array(out["node"], pa.int64()), "score": pa.array(out["score"], pa.float64())})

    by = ("shard", "dim", "block")
    hits = sent.groupBy(*by).cogroup(held.groupBy(*by)).applyInArrow(visit, "query_id bigint, node bigint, score double")
    # the nearest k + 1 nodes hold the nearest k rows; only these fetch their copies
    best = Window.partitionBy("query_id").orderBy("score", "node")
    hits = hits.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).drop("nth")
    heads = nodes.where("nth = 1").select("mark", "vec", F.col("id").alias("node"))
    members = nodes.join(heads, ["mark", "vec"]).select("node", F.col("id").alias("vec_id"))
    ranked = hits.join(members, "node").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
