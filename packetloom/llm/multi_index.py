"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut into two halves and each half is quantised by its own k-means,
so a cell is a pair of centroids. A query visits cells by summed squared
distance of its halves to the two centroids, found with a heap over the two
sorted centroid lists (an entry is pushed when its two predecessors are done),
until the cells hold ``share`` of all distinct vectors and ``least`` of them at
any rate. Visited entries are reranked by exact distance in double precision.

On data without clusters (random directions in 64 dimensions) the neighbours
lie in half of all cells, and no index of this kind can skip much: the default
``share`` is set for a recall above 0.9 there. With clusters a small share does.

Equal vectors are one entry that keeps its ``top + 1`` smallest ids, all that
an answer can use, and equal queries are one search; so a vector that a third
of the rows share costs one entry. Codebooks are fitted on at most ``sample``
distinct vectors (those of smallest hash); every vector is indexed. Entries are
dealt by first centroid into blocks of about ``block`` entries, queries into
chunks; a task holds one of each and returns the best few per query.

Null vectors, vectors with null or non-finite components, zero vectors and those of another
length than the most frequent one take no part, neither do rows without id.
Fewer candidates than ``top``: all of them. Empty tables give no rows. A repeated id with the
same vector is one candidate and one query, and never its own neighbour.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import map_batches, store

SHARE, LEAST = 0.6, 2_000
SAMPLE = 20_000
PER_CELL = 16
CENTROIDS = 256  # at most; the table of cells has its square of rows
BLOCK, CHUNK = 4_096, 2_048


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.transform(vector_col, lambda x: x.cast("double")).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine)
    # +0.0 and -0.0 are one value
    return rows.select("id", F.transform(v, lambda x: x + F.lit(0.0)).alias("v"))


def kmeans(points: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    centres = points[np.random.default_rng(seed).choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=k)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), dtype=np.int64)
    for i in range(0, len(points), 4096):
        part = points[i : i + 4096]
        out[i : i + 4096] = ((centres**2).sum(1)[None] - 2 * part @ centres.T).argmin(1)
    return out


def visit(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: float) -> Iterator[tuple[int, int]]:
    """Occupied cells in order of summed distance, until they hold ``wanted`` entries."""
    one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[one].tolist(), second[two].tolist()
    held, heap = 0, [(a[0] + b[0], 0, 0)]
    done_in_row = [0] * len(a)  # cells of row r done: places 0 .. done_in_row[r] - 1
    while heap and held < wanted:
        _, r, c = heapq.heappop(heap)
        done_in_row[r] = c + 1
        i, j = int(one[r]), int(two[c])
        if counts[i, j]:
            held += int(counts[i, j])
            yield i, j
        if r + 1 < len(a) and done_in_row[r + 1] == c:
            heapq.heappush(heap, (a[r + 1] + b[c], r + 1, c))
        if c + 1 < len(b) and (r == 0 or done_in_row[r - 1] > c + 1):
            heapq.heappush(heap, (a[r] + b[c + 1], r, c + 1))


class MultiIndex:
    """Index over all vectors of a table."""

    def __init__(self, vectors: DataFrame, id_col: str, vector_col: str, top: int = 10, sample: int = SAMPLE):
        self.top, rows = top, valid(vectors, id_col, vector_col)
        sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
        self.width = sizes.d if sizes else 0
        self.rows = rows.where(F.size("v") == self.width).distinct()
        # row_number below a limit is applied before the shuffle too: a hot vector sends top + 1 ids per task
        smallest = self.rows.withColumn("k", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("k") <= top + 1)
        entries = store(smallest.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                        .withColumn("e", F.monotonically_increasing_id()), "entries")
        self.count = entries.count()
        self.counts = np.zeros((1, 1), dtype=np.int64)
        if not self.count:
            return
        taken = entries.orderBy(F.xxhash64("v"), "e").limit(sample).select("v").collect()
        points = np.array([r.v for r in taken])
        half = self.width // 2
        k = max(1, min(CENTROIDS, len(points), int(sqrt(self.count / PER_CELL))))
        self.first, self.second = kmeans(points[:, :half], k), kmeans(points[:, half:], k)
        first, second = self.first, self.second

        def assign(batch: dict[str, list]) -> dict[str, object]:
            v = np.array(batch["v"])
            return {**batch, "i": nearest(v[:, :half], first), "j": nearest(v[:, half:], second)}

        self.entries = store(map_batches(entries, assign, "v array<double>, ids array<long>, e long, i int, j int"), "index")
        self.counts = np.zeros((k, k), dtype=np.int64)
        for r in self.entries.groupBy("i", "j").count().collect():  # at most CENTROIDS squared
            self.counts[r.i, r.j] = r["count"]

    def search(self, wanted: F.Column, share: float = SHARE, least: int = LEAST) -> DataFrame:
        """query_id, rank, vec_id, score for the rows that ``wanted`` (of column id) selects, against all rows."""
        spark, top = self.rows.sparkSession, self.top
        schema = "query_id long, rank int, vec_id long, score double"
        if not self.count:
            return spark.createDataFrame([], schema)
        asked = self.rows.where(wanted)
        queries = store(asked.select("v").distinct().withColumn("q", F.monotonically_increasing_id()), "queries")
        first, second, counts, half = self.first, self.second, self.counts, self.width // 2
        budget = max(least, share * self.count)
        pieces = np.maximum(1, np.ceil(counts.sum(1) / BLOCK)).astype(int)
        chunks = max(1, ceil(queries.count() / CHUNK))

        def probe(batch: dict[str, list]) -> dict[str, object]:
            out = {"q": [], "v": [], "i": [], "cells": []}
            for q, v in zip(batch["q"], batch["v"]):
                x, by_first = np.array(v), {}
                for i, j in visit(((first - x[:half]) ** 2).sum(1), ((second - x[half:]) ** 2).sum(1), counts, budget):
                    by_first.setdefault(i, []).append(j)
                for i, cells in by_first.items():
                    for k, value in (("q", q), ("v", v), ("i", i), ("cells", cells)):
                        out[k].append(value)
            return out

        of_first = F.element_at(F.lit([int(p) for p in pieces]), F.col("i") + 1)
        chunk_of = F.pmod(F.xxhash64("q"), F.lit(chunks)).cast("int")
        probed = store(map_batches(queries, probe, "q long, v array<double>, i int, cells array<int>").withColumn("chunk", chunk_of), "probes")
        probes = probed.select("*", F.explode(F.sequence(F.lit(0), of_first - 1)).alias("piece"))
        # an entry goes to the chunks that probe its first centroid; their lists are CENTROIDS rows
        asking = probed.groupBy("i").agg(F.collect_set("chunk").alias("chunks"))
        blocks = self.entries.join(asking, "i").select(
            "*", F.pmod(F.xxhash64("e"), of_first).cast("int").alias("piece"), F.explode("chunks").alias("chunk")).drop("chunks")
        keys = ["i", "piece", "chunk"]

        def rerank(entries: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            found = {"q": [], "id": [], "score": []}
            if len(entries) and len(asked):
                x, cell = np.array(entries["v"].tolist()), entries["j"].to_numpy()
                ids, norms = entries["ids"].tolist(), (x**2).sum(1)
                for lo in range(0, len(asked), 256):
                    part = asked.iloc[lo : lo + 256]
                    y = np.array(part["v"].tolist())
                    rough = norms[None] - 2 * y @ x.T + (y**2).sum(1)[:, None]
                    for q, point, line, cells in zip(part["q"].tolist(), y, rough, part["cells"].tolist()):
                        inside = np.flatnonzero(np.isin(cell, cells))
                        if not len(inside):
                            continue
                        if len(inside) > top + 1:
                            line = line[inside]
                            last = np.partition(line, top)[top]
                            slack = 1e-9 * (abs(last) + (point**2).sum() + 1e-300)
                            inside = inside[line <= last + slack]
                        exact = np.sqrt(((x[inside] - point) ** 2).sum(1))
                        best = sorted((float(d), int(n)) for d, e in zip(exact, inside) for n in ids[e])[: top + 1]
                        found["q"] += [q] * len(best)
                        found["score"] += [d for d, _ in best]
                        found["id"] += [n for _, n in best]
            return pd.DataFrame(found).astype({"q": "int64", "id": "int64", "score": "float64"})

        near = blocks.groupBy(*keys).cogroup(probes.groupBy(*keys)).applyInPandas(rerank, "q long, id long, score double")
        by = Window.partitionBy("q").orderBy("score", "id")
        best = near.withColumn("k", F.row_number().over(by)).where(F.col("k") <= top + 1)
        lists = best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("near"))
        lists = store(queries.join(lists, "q").select("v", "near"), "nearest")
        answers = asked.join(lists, "v").select(
            F.col("id").alias("query_id"),
            F.posexplode(F.slice(F.filter("near", lambda n: n["id"] != F.col("id")), 1, top)).alias("place", "n"))
        return answers.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("n.id").alias("vec_id"), F.col("n.score").alias("score"))
