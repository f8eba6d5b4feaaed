"""Exact search for the largest inner products with an M-tree.

Vectors are whole numbers; with one more component that brings all to the length of the longest, the largest inner product is the
smallest distance, which is a metric.  Equal vectors are one entry with the k + 1 smallest of their rows.  The tree's root page is
a bounded set of routing objects with covering radii, known to every task; under each lie subtrees of bounded size, built in one
task each: pages of routing objects with covering radii and distances to the page's own routing object, down to pages of vectors
with theirs.  A query first searches the subtree where it lies itself, which gives it a bound, then those that the root page
cannot rule out.  Within a subtree the page with the smallest possible distance comes first, and the stored distances rule
out entries before any distance is computed.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: Most routing objects of the root page; vectors of a subtree and queries of a task, on average.
ROOT, SUBTREE, QUERIES = 256, 4096, 2048
#: Routing objects of an inner page and vectors of a leaf.
FANOUT, LEAF = 16, 128
#: Rounding of distances, as a share of the longest vector.
SLACK = 1e-6

WHOLE = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("asked", pa.bool_()), ("v", pa.binary()), ("norm", pa.int64()), ("size", pa.int64())])
WHOLE_TYPE = "row long, vec_id long, asked boolean, v binary, norm long, size long"
#: Bytes of a component, as a vector's first byte says: two where all fit, else eight.
KINDS = {2: "<i2", 8: "<i8"}


def encoded(whole: np.ndarray) -> bytes:
    size = 2 if not len(whole) or int(np.abs(whole).max()) < 1 << 15 else 8
    return bytes([size]) + whole.astype(KINDS[size]).tobytes()


def whole_vectors(scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Components times ``scale``, rounded down, as whole numbers without the zeros at the end; unusable vectors are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, name, asked, vector in zip(*(batch.column(c).to_pylist() for c in ("row", "vec_id", "asked")), batch.column("v"), strict=True):
                if not vector.is_valid or vector.values.null_count:
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(scale * vector.values.to_numpy(zero_copy_only=False).astype(np.float64))
                    if np.isfinite(x).all() and float(x @ x) <= 2.0**62:
                        whole = np.trim_zeros(x.astype(np.int64), "b")
                        out.append((row, name, asked, encoded(whole), int(whole @ whole), len(whole)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(WHOLE)], schema=WHOLE)

    return run


class Space:
    """Vectors of up to ``width`` components, brought to the length of the longest."""

    def __init__(self, width: int, longest: int):
        self.width, self.longest = width, longest
        self.slack = SLACK * (1 + math.sqrt(longest))

    def whole(self, raw: list[bytes]) -> np.ndarray:
        out = np.zeros((len(raw), self.width), np.int64)
        for i, r in enumerate(raw):
            x = np.frombuffer(r, KINDS[r[0]], offset=1)
            out[i, : len(x)] = x
        return out

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        x = np.empty((len(vectors), self.width + 1))
        x[:, :-1] = vectors
        x[:, -1] = np.sqrt(np.maximum(self.longest - (vectors * vectors).sum(axis=1), 0))
        return x

    def radius(self, norm: int, score: float) -> float:
        """Distance within which all vectors with at least this score lie, for a query with this squared length."""
        return math.sqrt(max(norm + self.longest - 2.0 * score, 0.0)) + self.slack


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T), 0))


def nearest(space: Space, routes: list[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the number of the nearest routing object."""
    to = space.lifted(space.whole(routes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.empty(batch.num_rows, np.int32)
            raw = batch.column("v").to_pylist()
            for at in range(0, len(raw), 4096):
                cell[at : at + 4096] = distances(space.lifted(space.whole(raw[at : at + 4096])), to).argmin(axis=1)
            yield batch.append_column("cell", pa.array(cell))

    return run


class Tree:
    """Pages of entries in flat arrays: the vector, the page below (-1: none), the distance to the page's own routing object and,
    for routing objects, the covering radius."""

    def __init__(self, space: Space, vectors: np.ndarray, rows: list[list[tuple]], pages: tuple[np.ndarray, ...] | None = None):
        self.space, self.vectors, self.rows = space, vectors, rows
        self.norm = (vectors * vectors).sum(axis=1)
        # products of small numbers are exact in doubles, which multiply quicker
        self.exact = vectors.astype(np.float64) if float(space.longest) < 2.0**52 else vectors
        if pages is None:
            self._x = space.lifted(vectors)
            self._pages: list = []
            self._build(np.arange(len(vectors)), 0)
            first = np.cumsum([0, *(len(p[0]) for p in self._pages)])
            pages = (first, *(np.concatenate([p[i] for p in self._pages]) for i in range(4)))
        self.first, self.vector, self.below, self.apart, self.cover = pages

    def _build(self, own: np.ndarray, route: int) -> int:
        """Make the page of the vectors ``own`` under the routing object ``route``; parents precede their children."""
        at = len(self._pages)
        self._pages.append(None)
        if len(own) <= LEAF:
            apart = distances(self._x[own], self._x[route : route + 1])[:, 0]
            self._pages[at] = (own, np.full(len(own), -1), apart, np.zeros(len(own)))
            return at
        routes = own[np.linspace(0, len(own) - 1, min(FANOUT, -(-len(own) // LEAF))).astype(np.int64)]
        far = distances(self._x[own], self._x[routes])
        group = far.argmin(axis=1)
        if len(np.unique(group)) == 1:  # the numbers cannot tell them apart
            group = np.arange(len(own)) % len(routes)
        entries = []
        for g in np.unique(group).tolist():
            some = group == g
            entries.append((routes[g], self._build(own[some], int(routes[g])), far[some, g].max()))
        vector = np.array([e[0] for e in entries])
        apart = distances(self._x[vector], self._x[route : route + 1])[:, 0]
        self._pages[at] = (vector, np.array([e[1] for e in entries]), apart, np.array([e[2] for e in entries]))
        return at

    def packed(self) -> bytes:
        held = io.BytesIO()
        np.savez(held, first=self.first, vector=self.vector, below=self.below, apart=self.apart, cover=self.cover)
        return held.getvalue()

    def search(self, query: np.ndarray, k: int, least: int | None) -> list[tuple]:
        """The k best (score, null id, id, row) of this tree with at least the score ``least``, best first."""
        norm, space = int(query @ query), self.space
        by = query.astype(self.exact.dtype)
        within = math.inf if least is None else space.radius(norm, least)
        best: list[tuple] = []
        to = space.radius(norm, int(self.vectors[0] @ query)) - space.slack
        pages = [(0.0, 0, to)]
        while pages and pages[0][0] <= within:
            low, page, to = heapq.heappop(pages)
            a, b = self.first[page], self.first[page + 1]
            able = a + np.flatnonzero(np.abs(self.apart[a:b] - to) - self.cover[a:b] <= within + space.slack)
            if not len(able):
                continue
            score = (self.exact[self.vector[able]] @ by).astype(np.int64)
            if self.below[a] < 0:
                if least is not None:
                    able, score = able[score >= least], score[score >= least]
                if len(able) > k:
                    edge = np.partition(score, len(score) - k)[len(score) - k]
                    able, score = able[score >= edge], score[score >= edge]
                for vector, s in zip(self.vector[able].tolist(), score.tolist(), strict=True):
                    best += [(s, *row) for row in self.rows[vector]]
                if len(able):
                    best = sorted(best, key=lambda r: (-r[0], *r[1:]))[:k]
                    if len(best) == k:
                        least = best[-1][0]
                        within = space.radius(norm, least)
            else:
                to = np.sqrt(np.maximum(norm + space.longest - 2.0 * score, 0))
                below = np.maximum(to - self.cover[able] - space.slack, low)
                for p, d, t in zip(self.below[able].tolist(), below.tolist(), to.tolist(), strict=True):
                    if d <= within:
                        heapq.heappush(pages, (d, p, t))
        return best


ROWS = pa.list_(pa.struct([("none", pa.bool_()), ("id", pa.int64()), ("row", pa.int64())]))
TREES = pa.schema([("cell", pa.int32()), ("block", pa.int32()), ("pages", pa.binary()), ("vectors", pa.list_(pa.binary())), ("rows", pa.list_(ROWS)), ("cover", pa.float64())])
TREE_TYPE = "cell int, block int, pages binary, vectors array<binary>, rows array<array<struct<none: boolean, id: long, row: long>>>, cover double"


def plant(space: Space, routes: list[bytes]) -> Callable[[pa.Table], pa.Table]:
    """One subtree, and how far its vectors lie from the root page's routing object at most."""
    to = space.lifted(space.whole(routes))

    def run(group: pa.Table) -> pa.Table:
        raw = group["v"].to_pylist()
        vectors = space.whole(raw)
        tree = Tree(space, vectors, [])
        cell = group["cell"][0].as_py()
        cover = float(distances(space.lifted(vectors), to[cell : cell + 1]).max())
        rows = pa.array([group["rows"].to_pylist()], pa.list_(ROWS))
        return pa.table([pa.array([cell], pa.int32()), pa.array([group["block"][0].as_py()], pa.int32()), pa.array([tree.packed()]), pa.array([raw]), rows, pa.array([cover])], schema=TREES)

    return run


HITS = pa.schema([("query", pa.int64()), ("score", pa.int64()), ("none", pa.bool_()), ("id", pa.int64()), ("row", pa.int64())])
HIT_TYPE = "query long, score long, none boolean, id long, row long"


def look(space: Space, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Searches one subtree for a group of queries."""

    def run(queries: pa.Table, trees: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if queries.num_rows and trees.num_rows:
            pages = np.load(io.BytesIO(trees["pages"][0].as_py()))
            rows = [[(r["none"], r["id"], r["row"]) for r in own] for own in trees["rows"][0].as_py()]
            tree = Tree(space, space.whole(trees["vectors"][0].as_py()), rows, tuple(pages[n] for n in ("first", "vector", "below", "apart", "cover")))
            for number, query, least in zip(queries["query"].to_pylist(), space.whole(queries["v"].to_pylist()), queries["least"].to_pylist(), strict=True):
                out += [(number, *hit) for hit in tree.search(query, k, least)]
        return pa.table([pa.array([r[i] for r in out], f.type) for i, f in enumerate(HITS)], schema=HITS)

    return run


VISITS = pa.schema([("query", pa.int64()), ("v", pa.binary()), ("least", pa.int64()), ("home_cell", pa.int32()), ("home_block", pa.int32()), ("cell", pa.int32())])


def visits(space: Space, routes: list[bytes], cover: list[float]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The cells that a query has to visit, by the root page's covering radii."""
    to, radius = space.whole(routes).astype(np.float64), np.array(cover)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries = space.whole(batch.column("v").to_pylist())
            norm = (queries * queries).sum(axis=1)
            far = np.sqrt(np.maximum(norm[:, None] + space.longest - 2.0 * (queries.astype(np.float64) @ to.T), 0)) - radius[None, :]
            least = batch.column("least").to_pylist()
            within = np.array([math.inf if s is None else space.radius(int(n), s) for n, s in zip(norm, least, strict=True)])
            at, cell = np.nonzero(far <= within[:, None] + space.slack)
            own = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*(own.column(n) for n in VISITS.names[:-1]), pa.array(cell.astype(np.int32))], schema=VISITS)

    return run


def best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "none", "id", "row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mtree_search(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row where ``is_query`` its ``k`` best other rows: query_id, rank, vec_id, score.

    Components are multiplied by ``scale`` and rounded down; the score is the inner product.  Equal scores stand by ascending id,
    null ids last.  Vectors that are null, hold null or other than finite components, or whose squared length is over 2^62 (their
    scores don't fit) take no part; shorter vectors are as if ended by zeros.  Repeated rows are candidates each and, where they
    are queries, get their answers each; a query row is no answer to itself but its repetitions are.  Where there are fewer than
    ``k`` others all are returned; an empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    asked = F.coalesce(is_query, F.lit(False))
    given = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), asked.alias("asked"))
    rows = table(given.mapInArrow(whole_vectors(scale), WHOLE_TYPE), "rows")
    longest, width, n = rows.agg(F.max("norm"), F.max("size"), F.countDistinct("v")).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    space = Space(max(width, 1), longest)
    # of equal vectors only the k + 1 smallest rows can be answers: cut before the shuffle already
    order = Window.partitionBy("v").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    few = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    entry = F.struct(F.col("vec_id").isNull().alias("none"), F.col("vec_id").alias("id"), "row")
    distinct = few.groupBy("v").agg(F.sort_array(F.collect_list(entry)).alias("rows"))
    distinct = table(distinct.withColumn("query", F.monotonically_increasing_id()), "distinct")
    # the root page: a hash sample of bounded size
    cells = min(ROOT, math.ceil(n / SUBTREE))
    routes = [bytes(r["v"]) for r in distinct.select("v").orderBy(F.xxhash64("v"), "v").limit(cells).collect()]
    rows_type = distinct.schema["rows"].dataType.simpleString()
    dealt = table(distinct.mapInArrow(nearest(space, routes), f"v binary, rows {rows_type}, query long, cell int"), "cells")
    sizes = {r["cell"]: math.ceil(r["count"] / SUBTREE) for r in dealt.groupBy("cell").count().collect()}
    blocks = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("v", F.lit(1)), blocks[F.col("cell")]).cast("int"))
    trees = table(dealt.select("cell", "block", "v", "rows").groupBy("cell", "block").applyInArrow(plant(space, routes), TREE_TYPE), "trees")
    cover = {r["cell"]: r["cover"] for r in trees.groupBy("cell").agg(F.max("cover").alias("cover")).collect()}
    cover = [cover.get(i, -math.inf) for i in range(len(routes))]
    # queries by different vectors: the answers of k + 1 rows hold those of every row of the vector
    own = rows.where("asked")
    queries = dealt.join(own.select("v").distinct(), "v", "left_semi").select("query", "v", F.col("cell").alias("home_cell"), F.col("block").alias("home_block"))
    queries = table(queries, "queries")
    parts = math.ceil(queries.count() / QUERIES) or 1
    part = F.pmod(F.hash("query"), F.lit(parts)).cast("int").alias("part")
    wide = trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    keys = ("cell", "block", "part")

    def answers(dealt_out: DataFrame) -> DataFrame:
        return dealt_out.groupBy(*keys).cogroup(wide.groupBy(*keys)).applyInArrow(look(space, k + 1), HIT_TYPE)

    home = queries.select("query", "v", F.lit(None).cast("long").alias("least"), F.col("home_cell").alias("cell"), F.col("home_block").alias("block"), part)
    first = table(answers(home), "first")
    reached = first.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k + 1)
    bound = queries.join(reached, "query", "left").select("query", "v", "least", "home_cell", "home_block")
    to = bound.mapInArrow(visits(space, routes, cover), "query long, v binary, least long, home_cell int, home_block int, cell int")
    to = to.withColumn("block", F.explode(F.sequence(F.lit(0), (blocks[F.col("cell")] - 1).cast("int"))))
    to = to.where((F.col("cell") != F.col("home_cell")) | (F.col("block") != F.col("home_block"))).select("query", "v", "least", "cell", "block", part)
    found = table(best(first.unionByName(answers(to)), k + 1).drop("rank"), "found")
    asking = own.select(F.col("row").alias("own"), F.col("vec_id").alias("query_id"), "v").join(queries.select("query", "v"), "v").select("own", "query_id", "query")
    mine = asking.join(found, "query").where(F.col("own") != F.col("row"))
    ranked = Window.partitionBy("own").orderBy(F.col("score").desc(), "none", "id", "row")
    mine = mine.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return mine.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op11_mtree_search(spark, sf_dir: str) -> DataFrame:
    return mtree_search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


OP11_SQL = """
with e as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.row, q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from e q join e c on q.row <> c.row where q.vec_id % 50 = 0
), r as (
  select query_id, row_number() over (partition by row order by score desc, vec_id nulls last) as rank, vec_id, score from s
)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5
"""
