"""Nearest neighbours by an inverted multi-index.

Each vector is quantised in two halves with a codebook each; a cell is a pair of centroids.
A query ranks the centroids of each half by inner product and walks the pairs in order of the
sum with a heap, until the cells that it has seen hold enough vectors; these are scored in
double precision on the original vectors.

* The codebooks are fitted on at most ``FIT_ROWS`` vectors (those with the least hash of their
  id); every vector is indexed. The number of centroids follows the number of vectors, up to
  ``MOST_CENTROIDS``, so the table of cell sizes is bounded.
* How many vectors are enough is measured: for at most ``PROBES`` queries all vectors are scored,
  and the candidates are as many as it takes to reach ``RECALL`` of their true neighbours. On
  vectors without clusters this is a large share of all; on clustered ones a small one.
* Equal vectors: only the ``k + 1`` smallest ids of each can be among anybody's nearest, so only
  these are indexed (a partial limit cuts hot vectors before they are shuffled); equal queries
  are searched once. Both are exact.
* Queries and cells meet in a grid of blocks of at most ``QUERY_BLOCK`` queries and about
  ``VECTOR_BLOCK`` vectors. Large cells are dealt over several blocks.

Results: vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part, as queries or as candidates; a query's own id is no candidate; with
fewer candidates than ``k`` all are returned; ties go to the smaller id; rows with a null id
are left out; an empty input gives no rows; other columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeflow.llm.common import least_hashed, partitions_for, read, stored

FIT_ROWS = 20_000
MOST_CENTROIDS = 1024
PROBES = 200
RECALL = 0.96
QUERY_BLOCK = 1024
VECTOR_BLOCK = 20_000


def _valid(size: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vecs, query = [], [], []
            for i, v, q in zip(*(batch.column(c).to_pylist() for c in ("id", "vec", "query"))):
                if i is None or v is None or len(v) != size or None in v:
                    continue
                x = np.array(v, "<f8") + 0.0
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    vecs.append(x.tobytes())
                    query.append(bool(q))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary()), pa.array(query, pa.bool_())], ["id", "vec", "query"])

    return work


def _matrix(vecs: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(vecs), "<f8").reshape(len(vecs), size)


def fit_codebook(x: np.ndarray, centroids: int, rounds: int = 15, seed: int = 7) -> np.ndarray:
    """Lloyd's iterations from distinct rows; an empty centroid restarts at a random row."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    centers = distinct[rng.choice(len(distinct), min(centroids, len(distinct)), replace=False)].copy()
    for _ in range(rounds):
        near = assign(x, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        sizes = np.bincount(near, minlength=len(centers))
        centers = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], x[rng.integers(len(x), size=len(centers))])
    return centers


def assign(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers * centers).sum(axis=1) - 2 * x @ centers.T, axis=1)


def walk_cells(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells ``i * len(second) + j`` in falling order of ``first[i] + second[j]``, until they hold
    ``enough`` vectors. The heap holds at most one pair a row of the sorted table."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    x, y = (-first[a]).tolist(), (-second[b]).tolist()
    a, b, width = a.tolist(), b.tolist(), len(second)
    heap, out, held = [(x[0] + y[0], 0, 0)], [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = a[i] * width + b[j]
        if sizes[cell]:
            out.append(cell)
            held += sizes[cell]
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
    return out


def _nearest(ids: np.ndarray, x: np.ndarray, q: np.ndarray, approx: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of one query by score, then id; scores are sums in one fixed order, so equal
    vectors have equal scores."""
    if len(approx) > 4 * k:
        part = np.argpartition(-approx, 4 * k)[:4 * k]
        part = np.flatnonzero(approx >= approx[part].min())
    else:
        part = np.arange(len(approx))
    part = part[np.isfinite(approx[part])]
    score = (x[part] * q).sum(axis=1)
    order = np.lexsort((ids[part], -score))[:k]
    return part[order], score[order]


def _all_scores(table, size: int, k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = table.value
        for batch in batches:
            ids = np.asarray(batch.column("id"))
            if not len(ids):
                continue
            x = _matrix(batch.column("vec").to_pylist(), size)
            cell = np.asarray(batch.column("cell"))
            for n, q in enumerate(queries):
                part, score = _nearest(ids, x, q, x @ q, k)
                yield pa.RecordBatch.from_arrays([pa.array([n] * len(part), pa.int32()), pa.array(ids[part]), pa.array(cell[part]), pa.array(score)],
                                                 ["probe", "id", "cell", "score"])

    return work


def _cells(table, size: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = table.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vec").to_pylist(), size)
            cell = assign(x[:, :size // 2], one) * len(two) + assign(x[:, size // 2:], two)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vec"), pa.array(cell.astype(np.int64))], ["id", "vec", "cell"])

    return work


def _probe(table, size: int, blocks: int):
    """Each query once per block of vectors, with the cells that it wants there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, sizes, pieces, enough = table.value
        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("vec").to_pylist()):
                q = np.frombuffer(v, "<f8")
                cells = np.array(walk_cells(one @ q[:size // 2], two @ q[size // 2:], sizes, enough), np.int64)
                of = np.repeat(cells, pieces[cells])
                piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces[cells]) - pieces[cells], pieces[cells])
                block = (of * 31 + piece) % blocks
                order = np.argsort(block, kind="stable")
                block, of = block[order], of[order]
                at = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
                cut = list(zip(at.tolist(), [*at[1:].tolist(), len(of)]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(block[at], pa.int64()), pa.array([i] * len(cut), pa.int64()), pa.array([v] * len(cut), pa.binary()),
                    pa.array([of[a:b].astype("<i4").tobytes() for a, b in cut], pa.binary())], ["block", "id", "vec", "cells"])

    return work


def _score_block(size: int, k: int):
    def work(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out_q, out_i, out_s = [], [], []
        if len(vectors) and len(queries):
            vectors = vectors.sort_values("cell", kind="stable")
            cell, ids = vectors["cell"].to_numpy(), vectors["id"].to_numpy()
            x, q = _matrix(list(vectors["vec"]), size), _matrix(list(queries["vec"]), size)
            cells, first = np.unique(cell, return_index=True)
            last = np.append(first[1:], len(cell))
            for a in range(0, len(q), 256):
                wants = [np.frombuffer(c, "<i4") for c in queries["cells"].iloc[a:a + 256]]
                who = np.repeat(np.arange(len(wants)), [len(w) for w in wants])
                place = np.searchsorted(cells, np.concatenate(wants))
                place = np.where((place < len(cells)) & (cells[np.minimum(place, len(cells) - 1)] == np.concatenate(wants)), place, -1)
                who, place = who[place >= 0], place[place >= 0]
                order = np.argsort(place, kind="stable")
                who, place = who[order], place[order]
                approx = np.full((len(wants), len(x)), -np.inf)
                at = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else []
                for s, e in zip(at, [*at[1:], len(place)]):
                    f, t = first[place[s]], last[place[s]]
                    approx[who[s:e, None], np.arange(f, t)] = q[a + who[s:e]] @ x[f:t].T
                for n in range(len(wants)):
                    part, score = _nearest(ids, x, q[a + n], approx[n], k)
                    out_q += [int(queries["id"].iloc[a + n])] * len(part)
                    out_i += ids[part].tolist()
                    out_s += score.tolist()
        return pd.DataFrame({"class": np.array(out_q, np.int64), "vec_id": np.array(out_i, np.int64), "score": np.array(out_s, np.float64)})

    return work


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest found for each row that ``is_query`` holds for."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), is_query.alias("query"))
    common = rows.where("vec is not null").groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = int(common["size"]) if common else 0
    if size == 1:  # a second component of zero changes no inner product, and there are two halves
        rows = rows.where(F.size("vec") == 1).withColumn("vec", F.concat("vec", F.array(F.lit(0.0))))
        size = 2
    found = "query_id long, rank int, vec_id long, score double"
    rows = stored(rows.mapInArrow(_valid(size), "id long, vec binary, query boolean"), "vectors")
    same = Window.partitionBy("vec").orderBy("id")
    limited = stored(rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).select("id", "vec"), "candidates")
    total = limited.count()
    if not total:
        return spark.createDataFrame([], found)
    sample = _matrix(list(least_hashed(limited, "id", FIT_ROWS, total).toPandas()["vec"]), size)
    centroids = int(min(MOST_CENTROIDS, max(4, 2 ** round(np.log2(max(total, 12) / 12) / 2))))
    books = fit_codebook(sample[:, :size // 2], centroids), fit_codebook(sample[:, size // 2:], centroids)
    one, two = books
    index = stored(limited.mapInArrow(_cells(spark.sparkContext.broadcast(books), size), "id long, vec binary, cell long"), "index")
    sizes = np.zeros(len(one) * len(two), np.int64)
    for r in index.groupBy("cell").count().collect():  # at most a row per cell
        sizes[r["cell"]] = r["count"]

    classes = stored(rows.where("query").groupBy("vec").agg(F.min("id").alias("id")), "queries")
    n_classes = classes.count()
    probes = _matrix(list(least_hashed(classes, "id", PROBES, n_classes).toPandas()["vec"]), size)
    enough = total
    if len(probes):
        scored = index.mapInArrow(_all_scores(spark.sparkContext.broadcast(probes), size, k + 1), "probe int, id long, cell long, score double")
        best = Window.partitionBy("probe").orderBy(F.desc("score"), "id")
        true = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1).select("probe", "cell").collect()
        need = []
        for n, q in enumerate(probes):
            order = walk_cells(one @ q[:size // 2], two @ q[size // 2:], sizes, total)
            reach = dict(zip(order, np.cumsum(sizes[order]).tolist()))
            need += [reach[r["cell"]] for r in true if r["probe"] == n]
        enough = int(np.quantile(need, RECALL))

    blocks = max(1, -(-total // VECTOR_BLOCK))  # each gives its k + 1 best of a query: no more than needed
    pieces = np.maximum(1, -(-sizes // (VECTOR_BLOCK // 4)))
    query_blocks = max(1, -(-n_classes // QUERY_BLOCK))
    table = spark.sparkContext.broadcast((one, two, sizes, pieces, enough))
    split = spark.createDataFrame([(int(c), int(pieces[c])) for c in np.flatnonzero(pieces > 1)], "cell long, pieces int")
    dealt = (index.join(F.broadcast(split), "cell", "left")  # large cells only: at most 4 * total / VECTOR_BLOCK rows
             .withColumn("block", F.pmod(F.col("cell") * 31 + F.pmod(F.xxhash64("id"), F.coalesce("pieces", F.lit(1))), F.lit(blocks)))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))).select("block", "part", "id", "vec", "cell"))
    asked = (classes.select("id", "vec").repartition(partitions_for(spark, 1, 1)).mapInArrow(_probe(table, size, blocks), "block long, id long, vec binary, cells binary")
             .withColumn("part", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int")).select("block", "part", "id", "vec", "cells"))
    hits = (dealt.groupBy("block", "part").cogroup(asked.groupBy("block", "part"))
            .applyInPandas(_score_block(size, k + 1), "class long, vec_id long, score double"))
    best = Window.partitionBy("class").orderBy(F.desc("score"), "vec_id")
    hits = stored(hits.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1), "hits")
    asks = rows.where("query").select("id", "vec").join(classes.withColumnRenamed("id", "class"), "vec").select(F.col("id").alias("query_id"), "class").distinct()
    own = Window.partitionBy("query_id").orderBy("place")
    return (asks.join(hits, "class").where("vec_id <> query_id").withColumn("rank", F.row_number().over(own))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def op6_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all."""
    return nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
