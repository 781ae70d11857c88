"""Hard negatives by a cover tree over norm-augmented vectors.

1. An extra component sqrt(M**2 - |x|**2), M the largest norm, puts all
   candidates on a sphere; an anchor's extra component is 0. A squared distance
   is then |q|**2 + M**2 - 2 q.x, so distances bound inner products.
2. The upper tree is fitted on a bounded sample: farthest-first order gives
   nested levels of 1, ``FANOUT``, ``FANOUT``**2, ... centres. Every row descends
   to a leaf; the covering radius of a node is the largest distance of any row
   below it, taken over all rows. Leaves are cut into blocks of about ``BLOCK``
   rows (by a hash, so copies spread too).
3. An anchor descends level by level and keeps the nodes whose bounds meet one of
   its windows. Windows start at the k-th best score among the sample rows, so
   most leaves are left before any row is read.
4. Rows meet anchors by block: a task reads a block's rows, grows the lower tree
   (nodes of about ``NODE`` rows), then streams the anchors past it, best node
   bound first, raising each window to its k-th score; rows of the nodes left
   get exact integer products.
5. The same search runs twice: for positives (same label, one open window) and
   for negatives (other labels, a window for each positive).

Bounds are widened by ``SLACK`` of the squared norms, far above the rounding of
doubles, so nothing is lost; scores are integers.

Defined results: rows with a null label or vector, null or non-finite
components, or components of magnitude 2**27 or more after scaling take no part;
a shorter vector ends in zeros; rows that repeat id, label and vector count once;
rows with another vector are others even if they repeat an id, but an anchor's
positives have other ids; rows without an id are no anchors, come last among ties
and are returned with a null id (as is an id of 2**63 - 1); an anchor without
positives or negatives has no rows; an empty table gives an empty result; extra
input columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import hash_bucket, prepare_python, saved, table
from larder.llm.vectors import matrix, products, scaled, usable

#: Production parameters.
SCALE = 256
ANCHORS = 100
SHIFT = 7
LABELS = 10
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
#: Rows (smallest hashes) on which the upper tree is fitted; its leaves at most.
SAMPLE = 4096
FANOUT = 8
LEAVES = 512
BLOCK = 2048
NODE = 64
SLACK = 1e-9
#: Arrow rows handled at a time.
BATCH = 2048

NO_ID = (1 << 63) - 1
LEAST, MOST = -(1 << 62), 1 << 62


def augmented(v: np.ndarray, top: float) -> np.ndarray:
    """Rows with sqrt(top - |x|**2) as their last component."""
    x = v.astype(np.float64)
    rest = np.maximum(top - np.einsum("ij,ij->i", x, x), 0)
    return np.hstack([x, np.sqrt(rest)[:, None]])


def farthest_first(x: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Up to ``count`` rows of ``x``, each farthest from those before it; every
    row's centre and its distance to it. Stops when nothing is left uncovered."""
    chosen, of = [0], np.zeros(len(x), np.int64)
    near = np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < count and near.max() > 0:
        nxt = int(near.argmax())
        d = np.linalg.norm(x - x[nxt], axis=1)
        closer = d < near
        of[closer], near[closer] = len(chosen), d[closer]
        chosen.append(nxt)
    return np.array(chosen), of, near


@dataclass
class UpperTree:
    """Nested levels of centres: level j is the first ``sizes[j]`` of ``centres``;
    ``parents[j]`` names each one's parent on the level above, ``radii[j]`` covers
    all rows below it (no rows: -1)."""

    centres: np.ndarray
    sizes: list[int]
    parents: list[np.ndarray]
    radii: list[np.ndarray]
    top: float

    @classmethod
    def fit(cls, sample: np.ndarray, leaves: int, top: float) -> UpperTree:
        x = augmented(sample, top)
        chosen, _, _ = farthest_first(x, leaves)
        sizes = [1]
        while sizes[-1] < len(chosen):
            sizes.append(min(sizes[-1] * FANOUT, len(chosen)))
        c = x[chosen]
        parents = [np.zeros(1, np.int64)]
        for above, n in zip(sizes, sizes[1:]):
            parents.append(np.linalg.norm(c[:n, None] - c[None, :above], axis=2).argmin(axis=1))
        return cls(c, sizes, parents, [], top)

    def descend(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of every row (nearest child, level by level) and its distances to
        the centres on its way, one column a level."""
        x = augmented(v, self.top)
        at, way = np.zeros(len(x), np.int64), []
        for n, parent in zip(self.sizes, self.parents):
            c = self.centres[:n]
            d = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * x @ c.T, 0))
            d = np.where(parent[None, :] == at[:, None], d, np.inf)
            at = d.argmin(axis=1)
            way.append(np.linalg.norm(x - c[at], axis=1))
        return at, np.stack(way, axis=1)

    def cover(self, leaves: dict[int, list[float]]) -> None:
        """Set the radii from each used leaf's largest distances by level."""
        self.radii = [np.full(n, -1.0) for n in self.sizes]
        for leaf, way in leaves.items():
            at = leaf
            for j in range(len(self.sizes) - 1, -1, -1):
                self.radii[j][at] = max(self.radii[j][at], way[j])
                at = self.parents[j][at]

    def open_leaves(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """(anchors, leaves): whether rows of the leaf may lie in a window."""
        alive = np.ones((len(q), 1), bool)
        for n, parent, radius in zip(self.sizes, self.parents, self.radii):
            least, most = bounds(q, self.centres[:n], radius, self.top)
            alive = alive[:, parent] & (radius >= 0)[None, :] & meets(least, most, low, high)
        return alive


def bounds(q: np.ndarray, centres: np.ndarray, radius: np.ndarray, top: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of an anchor with a row of each node."""
    x = q.astype(np.float64)
    norm = np.einsum("ij,ij->i", x, x)[:, None] + top
    d = np.sqrt(np.maximum(norm - 2 * (x @ centres[:, :-1].T), 0))
    slack = SLACK * norm + 1
    return ((norm - (d + radius[None, :]) ** 2) / 2 - slack,
            (norm - np.maximum(d - radius[None, :], 0) ** 2) / 2 + slack)


def meets(least: np.ndarray, most: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether bounds (anchors, nodes) meet any window (anchors, windows)."""
    out = np.zeros(least.shape, bool)
    for w in range(low.shape[1]):
        out |= (most >= low[:, w, None]) & (least <= high[:, w, None])
    return out & (least <= most)


def allowed(a_label: np.ndarray, a_id: np.ndarray, label: np.ndarray, ids: np.ndarray, same: bool) -> np.ndarray:
    """(anchors, rows): rows of the same label with another id, or of other labels."""
    equal = a_label[:, None] == label[None, :]
    return equal & (a_id[:, None] != ids[None, :]) if same else ~equal


def kth_best(scores: np.ndarray, ok: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest admitted score of each anchor (fewer: LEAST)."""
    if scores.shape[1] < k:
        return np.full(len(scores), LEAST, np.int64)
    s = np.where(ok, scores, LEAST)
    return np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]


class Block:
    """Rows of a block below their lower tree."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, top: float):
        x = augmented(v, top)
        chosen, of, near = farthest_first(x, max(1, -(-len(v) // NODE)))
        order = np.argsort(of, kind="stable")
        self.ids, self.labels, self.v, self.top = ids[order], labels[order], v[order], top
        self.ends = np.searchsorted(of[order], np.arange(len(chosen) + 1))
        self.centres = x[chosen]
        self.radius = np.maximum.reduceat(near[order], self.ends[:-1])

    def search(self, q, a_id, a_label, low, high, k: int, same: bool):
        """(anchor, window, score, id) arrays: at least the k best rows of every
        window of this block that reach its lower end."""
        low = low.copy()
        least, most = bounds(q, self.centres, self.radius, self.top)
        hits: list[tuple] = []
        for node in np.argsort(-most.max(axis=0)):  # best bound first
            rows = slice(self.ends[node], self.ends[node + 1])
            use = np.flatnonzero(meets(least[:, [node]], most[:, [node]], low, high)[:, 0])
            if not len(use):
                continue
            s = products(q[use], self.v[rows])
            ok = allowed(a_label[use], a_id[use], self.labels[rows], self.ids[rows], same)
            for w in range(low.shape[1]):
                fits = ok & (s <= high[use, w, None]) & (s >= low[use, w, None])
                low[use, w] = np.maximum(low[use, w], kth_best(s, fits, k))
                a, r = np.nonzero(fits & (s >= low[use, w, None]))
                if len(a):
                    hits.append((use[a], np.full(len(a), w), s[a, r], self.ids[rows][r]))
        if not hits:
            return [np.zeros(0, np.int64)] * 4
        a, w, s, i = (np.concatenate(x) for x in zip(*hits))
        keep = s >= low[a, w]
        a, w, s, i = a[keep], w[keep], s[keep], i[keep]
        order = np.lexsort((i, -s, w, a))
        a, w, s, i = a[order], w[order], s[order], i[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])])) if len(a) else []
        rank = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a)))) if len(a) else a
        return [x[rank < k] for x in (a, w, s, i)]


def vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, v) of the distinct rows that take part."""
    x, label = F.col(vec_col), F.col(label_col).cast("long")
    i = F.col(id_col).cast("long")
    moved_label = F.when(F.coalesce(i % SHIFT == 0, F.lit(False)), (label + 1) % LABELS).otherwise(label)
    return (df.filter(label.isNotNull() & usable(x, scale))
            .select(F.coalesce(i, F.lit(NO_ID)).alias("id"), moved_label.alias("label"),
                    scaled(x, scale).cast("array<int>").alias("v")).distinct())


def _windows(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _longs(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))


class Searcher:
    """The tree over a table of vectors, and searches of it."""

    def __init__(self, rows: DataFrame):
        self.spark = rows.sparkSession
        norm = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x.cast("long"))
        n, top, dims = rows.agg(F.count(F.lit(1)), F.max(norm), F.max(F.size("v"))).first()
        self.n, self.dims, self.top = n, dims or 0, float(top or 0)
        some = rows.orderBy(F.xxhash64("id", "v"), "id", "v").limit(SAMPLE).toArrow()  # at most SAMPLE rows
        self.sample = (some.column("id").to_numpy(), some.column("label").to_numpy(), matrix(some.column("v"), self.dims))
        tree = UpperTree.fit(self.sample[2], min(LEAVES, max(1, -(-n // BLOCK))), self.top) if n else None
        self.tree, dims = tree, self.dims
        if tree is None:
            return

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                leaf, way = tree.descend(matrix(b.column("v"), dims))
                offsets = np.arange(0, way.size + 1, way.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf.astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(way.ravel())),
                     *b.columns], ["leaf", "way", "id", "label", "v"])
        placed = saved(rows.select("id", "label", "v").mapInArrow(
            place, "leaf int, way array<double>, id long, label long, v array<int>"), "cover-rows")
        # One row for each leaf: at most LEAVES.
        found = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), *[
            F.max(F.col("way")[j]).alias(f"w{j}") for j in range(len(tree.sizes))]).collect()
        tree.cover({r["leaf"]: [r[f"w{j}"] for j in range(len(tree.sizes))] for r in found})
        cuts = {r["leaf"]: -(-r["n"] // BLOCK) for r in found}
        self.cuts = [cuts.get(i, 1) for i in range(tree.sizes[-1])]
        part = F.pmod(F.xxhash64("id", "v"), self._cut(F.col("leaf")))
        self.rows = placed.select(self._block(F.col("leaf"), part), "id", "label", "v")

    def _cut(self, leaf: Column) -> Column:
        return F.get(F.array(*[F.lit(c).cast("long") for c in self.cuts]), leaf)

    @staticmethod
    def _block(leaf: Column, part: Column) -> Column:
        return (F.shiftleft(leaf.cast("long"), 40) + part).alias("block")

    def search(self, anchors: DataFrame, windows: int, k: int, same: bool) -> DataFrame:
        """The first ``k`` rows (a, w, rank, score, id) of every window of ``anchors``
        (a, id, label, v, low, high: arrays of ``windows`` long)."""
        tree, sample, dims, top = self.tree, self.sample, self.dims, self.top

        def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, labels, v = sample
            for b in batches:
                q = matrix(b.column("v"), dims)
                low, high = _windows(b, "low", windows), _windows(b, "high", windows)
                s = products(q, v)
                ok = allowed(b.column("label").to_numpy(), b.column("id").to_numpy(), labels, ids, same)
                for w in range(windows):
                    fits = ok & (s >= low[:, w, None]) & (s <= high[:, w, None])
                    low[:, w] = np.maximum(low[:, w], kth_best(s, fits, k))
                a, leaf = np.nonzero(tree.open_leaves(q, low, high))
                pick = pa.array(a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf.astype(np.int32)), *[b.column(c).take(pick) for c in ("a", "id", "label", "v")],
                     _longs(low[a]), _longs(high[a])], ["leaf", "a", "id", "label", "v", "low", "high"])
        columns = "id long, label long, v array<int>, low array<long>, high array<long>"
        asked = anchors.select("a", "id", "label", "v", "low", "high").mapInArrow(leaves, f"leaf int, a long, {columns}")
        asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), self._cut(F.col("leaf")) - 1)))
        none = F.lit(None).cast("array<long>")
        both = self.rows.select("block", F.lit(None).cast("long").alias("a"), "id", "label", "v", none.alias("low"),
                                none.alias("high")).union(
            asked.select(self._block(F.col("leaf"), F.col("part")), "a", "id", "label", "v", "low", "high"))

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Blocks in order; a block's rows, then its anchors."""
            current, held, tree_of = None, [], None
            for b in batches:
                block = b.column("block").to_numpy()
                row = b.column("a").is_null().to_numpy(zero_copy_only=False)
                cut = np.flatnonzero((block[1:] != block[:-1]) | (row[1:] != row[:-1])) + 1
                for start, end in zip(np.append(0, cut), np.append(cut, len(block))):
                    if start == end:
                        continue
                    p = b.slice(start, end - start)
                    if block[start] != current:
                        current, held, tree_of = block[start], [], None
                    v = matrix(p.column("v"), dims)
                    ids, labels = p.column("id").to_numpy(), p.column("label").to_numpy()
                    if row[start]:
                        held.append((ids, labels, v))
                        continue
                    if tree_of is None and held:
                        tree_of = Block(*[np.concatenate(x) for x in zip(*held)], top)
                        held = []
                    if tree_of is not None:
                        a, w, s, i = tree_of.search(v, ids, labels, _windows(p, "low", windows),
                                                    _windows(p, "high", windows), k, same)
                        yield pa.RecordBatch.from_arrays(
                            [p.column("a").take(pa.array(a)), pa.array(w.astype(np.int32)), pa.array(s), pa.array(i)],
                            ["a", "w", "score", "id"])
        hits = (both.repartition("block").sortWithinPartitions("block", F.asc_nulls_first("a"))
                .mapInArrow(meet, "a long, w int, score long, id long"))
        best = Window.partitionBy("a", "w").orderBy(F.desc("score"), "id")
        return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = df.sparkSession
    prepare_python(spark, BATCH)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = saved(vectors(df, id_col, vec_col, label_col, scale), "cover-vectors")
    finder = Searcher(rows)
    if finder.tree is None:
        return spark.createDataFrame([], schema)
    anchors = saved(rows.filter((F.col("id") % ANCHORS == 0) & (F.col("id") != NO_ID))
                    .withColumn("a", F.monotonically_increasing_id()), "cover-anchors")

    def one(value: int) -> Column:
        return F.array(F.lit(value).cast("long"))
    positives = saved(finder.search(anchors.withColumns({"low": one(LEAST), "high": one(MOST)}), 1, POSITIVES, True)
                      .select("a", F.col("rank").alias("w"), F.col("id").alias("positive_id"),
                              F.col("score").alias("positive_score")), "cover-positives")
    # Windows in the order of the positives; an absent one is empty.
    lists = positives.groupBy("a").agg(F.map_from_entries(F.collect_list(F.struct("w", "positive_score"))).alias("m"))

    def ends(value, absent: int) -> Column:
        return F.array(*[F.coalesce(value(F.try_element_at("m", F.lit(w))), F.lit(absent).cast("long"))
                         for w in range(1, POSITIVES + 1)])
    asked = anchors.join(lists, "a").withColumns({
        "low": ends(lambda p: F.ceil(p * LOW / F.lit(100).cast("decimal(3,0)")).cast("long"), 1),
        "high": ends(lambda p: F.floor(p * HIGH / F.lit(100).cast("decimal(3,0)")).cast("long"), 0)})
    negatives = finder.search(asked, POSITIVES, NEGATIVES, False).select(
        "a", (F.col("w") + 1).alias("w"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))

    def named(column: str) -> Column:
        return F.nullif(F.col(column), F.lit(NO_ID)).alias(column)
    return saved(negatives.join(positives, ["a", "w"]).join(anchors.select("a", F.col("id").alias("anchor_id")), "a").select(
        "anchor_id", named("positive_id"), "rank", named("negative_id"), "positive_score", "negative_score"), "cover-result")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: hard negatives of every anchor."""
    return hard_negatives(table(spark, sf_dir, "embeddings"))


#: Every score, ranked by windows.
SQL = f"""
WITH r AS MATERIALIZED (SELECT DISTINCT vec_id, CASE WHEN vec_id % {SHIFT} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score FROM r a, r b WHERE a.vec_id % {ANCHORS} = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same AND other IS DISTINCT FROM anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES})
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INTEGER AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= {NEGATIVES}
"""
