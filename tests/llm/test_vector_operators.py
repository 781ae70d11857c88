"""Hard negatives, mixing and centroid clustering against brute force and SQL."""

import collections
import math

import duckdb
import numpy as np
import pytest

from larder.llm import cover_tree, laesa, systematic
from larder.llm.vectors import products
from llm_fixtures import SF001, SF01, no_docs, odd_docs  # noqa: F401

SCHEMA = "vec_id long, embedding array<float>, label int, block long, a string, rank string, cluster int"
BIG = 2 ** 60


def vector_rows(rng, n=300, dims=64, at=0):
    x = rng.normal(size=(n, dims)) / 8
    return [(at + i, [float(np.float32(v)) for v in row], int(i % 3), 1, "x", "r", 9) for i, row in enumerate(x)]


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Nulls everywhere, other lengths, copies, repeated rows, wide ids."""
    rng = np.random.default_rng(5)
    rows = vector_rows(rng)
    same = rows[7][1]
    tail = (1, "x", "r", 9)
    rows += [(1000 + i, same, i % 3, *tail) for i in range(400)]
    rows += [(BIG + 1 + i, rows[i][1], 1, *tail) for i in range(8)] + [(100 * (BIG // 100), same, 2, *tail)]
    rows += [(5000, None, 1, *tail), (5100, [], 1, *tail), (5200, [None] * 64, 1, *tail), (5300, same, None, *tail),
             (5400, [math.nan] * 64, 1, *tail), (5500, [math.inf] * 64, 1, *tail), (5600, [-math.inf] * 64, 1, *tail),
             (5700, [3e38] * 64, 1, *tail), (5701, [-3e38] * 64, 1, *tail), (5800, same[:5], 1, *tail),
             (5900, [0.0] * 64, 1, *tail), (None, same, 1, *tail), (None, rows[1][1], 2, *tail), (200, rows[200][1], 2, *tail)]
    rows += [(None, [f * v for v in rows[200][1]], 1, *tail) for f in (0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5)]
    rows += [rows[100], rows[100], rows[3]]
    return spark.createDataFrame(rows, SCHEMA)


def collected(df):
    return collections.Counter(tuple(r) for r in df.collect())


def brute_vectors(df, scale, dims=None):
    out = []
    for r in df.collect():
        x = r["embedding"]
        if x is None or (dims and len(x) != dims) or any(v is None or not math.isfinite(v) for v in x):
            continue
        v = [math.floor(scale * float(np.float32(c))) for c in x]
        if all(-2 ** 27 <= c < 2 ** 27 for c in v):
            out.append((r["vec_id"], r["label"], v))
    return out


def brute_negatives(df):
    rows = set()
    for i, label, v in brute_vectors(df, 256):
        if label is not None:
            rows.add((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, tuple(v)))
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = collections.Counter()
    for a in rows:
        if a[0] is None or a[0] % 100:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(a[2], b[2])), k) for k, b in enumerate(rows)))
        positives = [(s, k) for s, k in scored if rows[k][1] == a[1] and rows[k][0] != a[0]][:5]
        for p, k in positives:
            fits = [(s, j) for s, j in scored if rows[j][1] != a[1] and 30 * -p <= 100 * -s <= 90 * -p][:10]
            for rank, (s, j) in enumerate(fits, 1):
                out[(a[0], rows[k][0], rank, rows[j][0], -p, -s)] += 1
    return out


def test_hard_negatives_match_brute_force(spark, odd_vectors):
    got = collected(cover_tree.hard_negatives(odd_vectors))
    assert got == brute_negatives(odd_vectors)
    assert any(k[0] > BIG // 2 for k in got) and any(k[3] is None for k in got)


def test_hard_negatives_match_sql(spark):
    for sf in (SF001, SF01):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
        got = cover_tree.query(spark, sf)
        want = con.execute(cover_tree.SQL).fetchall()
        assert collected(got) == collections.Counter(want) and want


def test_nothing_to_search(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cover_tree.hard_negatives(empty).count() == 0
    assert laesa.cluster_vectors(empty).count() == 0
    alone = spark.createDataFrame([(100, [0.5] * 64, 1), (101, [0.5] * 64, 2)], "vec_id long, embedding array<float>, label int")
    assert cover_tree.hard_negatives(alone).count() == 0  # no positive


def grouped(rng, groups=12, each=200, dims=16):
    centres = rng.normal(size=(groups, dims)) * 400
    return np.rint(np.repeat(centres, each, 0) + rng.normal(size=(groups * each, dims)) * 12).astype(np.int64)


def test_cover_tree_bounds_and_levels():
    rng = np.random.default_rng(3)
    v = grouped(rng)
    top = float((v * v).sum(1).max())
    tree = cover_tree.UpperTree.fit(v[::4], 40, top)
    leaf, way = tree.descend(v)
    assert way.shape == (len(v), len(tree.sizes)) and tree.sizes[0] == 1 and tree.sizes[-1] == tree.centres.shape[0]
    tree.cover({int(x): way[leaf == x].max(axis=0).tolist() for x in np.unique(leaf)})
    assert all((a[a >= 0].max() >= b.max() - 1e-9) for a, b in zip(tree.radii, tree.radii[1:]))  # covers shrink by level
    q = v[::50]
    s = products(q, v)
    for radius, n in zip(tree.radii, tree.sizes):
        at = leaf
        for j in range(len(tree.sizes) - 1, tree.sizes.index(n), -1):
            at = tree.parents[j][at]
        least, most = cover_tree.bounds(q, tree.centres[:n], radius, top)
        assert (least[:, at] <= s).all() and (s <= most[:, at]).all()
    # Windows near each anchor's own score leave most leaves unread.
    high = s.max(axis=1)[:, None]
    alive = tree.open_leaves(q, high - high // 50, high)
    assert alive.mean() < 0.35
    assert all(alive[i, leaf[j]] for i, j in zip(*np.nonzero(s >= high - high // 50)))


def test_block_search_matches_brute_force_with_ties():
    rng = np.random.default_rng(9)
    v = np.concatenate([grouped(rng, 6, 40), np.tile(grouped(rng, 1, 1), (150, 1))])
    ids, labels = rng.permutation(len(v)), rng.integers(0, 3, len(v))
    block = cover_tree.Block(ids, labels, v, float((v * v).sum(1).max()))
    q, a_id, a_label = v[:25], ids[:25], labels[:25]
    s = products(q, v)
    low, high = np.stack([s.mean(1), s.min(1)], 1).astype(np.int64), np.stack([s.max(1), s.mean(1)], 1).astype(np.int64)
    for same in (True, False):
        a, w, score, i = block.search(q, a_id, a_label, low, high, 7, same)
        got = collections.defaultdict(list)
        for row in zip(a.tolist(), w.tolist(), score.tolist(), i.tolist()):
            got[row[:2]].append(row[2:])
        for x in range(len(q)):
            for y in range(2):
                ok = [(int(s[x, j]), int(ids[j])) for j in range(len(v)) if low[x, y] <= s[x, j] <= high[x, y]
                      and ((labels[j] == a_label[x] and ids[j] != a_id[x]) if same else labels[j] != a_label[x])]
                assert got[(x, y)] == sorted(ok, key=lambda t: (-t[0], t[1]))[:7]


def brute_clusters(df):
    import hashlib
    rows = brute_vectors(df, 1024, 64)
    key = [(i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, _, v in rows]
    order = sorted(range(len(rows)), key=lambda k: key[k])
    v = np.array([r[2] for r in rows], dtype=object)
    c = [list(v[k]) for k in order[:8]]

    def assign():
        d = np.array([((v - np.array(x, dtype=object)) ** 2).sum(axis=1) for x in c]).T
        return d.argmin(axis=1), d.min(axis=1)
    for _ in range(10):
        own, _ = assign()
        c = [[int(t) // int((own == k).sum()) for t in v[own == k].sum(axis=0)] if (own == k).any() else x
             for k, x in enumerate(c)]
    own, d = assign()
    per = [int(d[own == k].sum()) if (own == k).any() else 0 for k in range(len(c))]
    return collections.Counter(
        (rows[k][0], int(own[k]), int(d[k]), per[own[k]], sum(per),
         hashlib.sha256(",".join(map(str, c[own[k]])).encode()).hexdigest()) for k in range(len(rows)))


def test_clusters_match_brute_force(spark, odd_vectors):
    got = collected(laesa.cluster_vectors(odd_vectors))
    assert got == brute_clusters(odd_vectors)
    assert {k[0] for k in got} >= {None, BIG + 1, BIG + 3}


def test_clusters_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF001}/embeddings.parquet'")
    assert collected(laesa.query(spark, SF001)) == collections.Counter(con.execute(laesa.SQL).fetchall())


def test_fewer_vectors_than_centroids(spark):
    few = spark.createDataFrame([(1, [1.0] * 64), (2, [1.0] * 64), (None, [2.0] * 64)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["cluster"], r["distance"]) for r in laesa.cluster_vectors(few).collect()}
    assert {i: d for i, (_, d) in got.items()} == {1: 0, 2: 0, None: 0} and got[1][0] == got[2][0] != got[None][0]


def test_pivots_skip_centroids():
    rng = np.random.default_rng(1)
    v = grouped(rng)
    pivots, centroids = laesa.far_apart(v, 8), v[::300]
    table = np.stack([laesa.squared(v, p) for p in pivots], axis=1)
    cluster, best, exact = laesa.nearest(v, table, pivots, centroids)
    d = np.stack([laesa.squared(v, c) for c in centroids], axis=1)
    assert (cluster == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert exact < 0.4 * d.size  # far centroids get no exact distance
    # Ties go to the smaller number whatever the guess.
    twice = np.concatenate([centroids, centroids])
    assert (laesa.nearest(v, table, pivots, twice)[0] == cluster).all()


def sql_mix(docs):
    con = duckdb.connect()
    con.register("documents", docs)
    return con.execute(systematic.SQL).fetchall()


def mix_rows(df):
    return collected(df.select("doc_id", "size", "source_size", "target", "taken"))


def test_mix_matches_sql(spark, odd_docs):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF01}/documents.parquet'")
    first = mix_rows(systematic.query(spark, SF01))
    assert first == collections.Counter(con.execute(systematic.SQL).fetchall())
    assert first == mix_rows(systematic.query(spark, SF01))  # reruns agree
    odd = odd_docs.withColumn("source", odd_docs["text"].substr(1, 1)).drop("_bucket")
    assert mix_rows(systematic.mixed(odd)) == collections.Counter(sql_mix(odd.toPandas()))


def test_mix_takes_the_targets(spark):
    rows, k = [], 0
    sizes = {"a": 300, "b": 4000, "c": 900, None: 50, "é": 700, "empty": 3, "z": 1}
    rng = np.random.default_rng(2)
    for source, n in sizes.items():
        for _ in range(n):
            words = 0 if source == "empty" else int(rng.pareto(1.5) * 20) + 1
            rows.append((None if k % 97 == 0 else BIG + k, "w " * words, source))
            k += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = systematic.mixed(docs).toPandas()
    assert len(got) == len(rows) and (got["taken"] <= 2 * got["size"]).all()
    total = got["size"].sum()
    per = got.assign(key=got["source"].fillna("~null")).groupby("key").agg(
        size=("size", "sum"), n=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"), top=("size", "max"))
    assert (per["size"] == per["n"]).all()
    assert per["target"].sum() == pytest.approx(1.5 * total)
    assert (per["target"] <= 2 * per["size"]).all()
    assert ((per["taken"] - per["target"]).abs() <= 2 * per["top"]).all()  # whole texts: a document or two
    weights = dict(zip(["a", "b", "c", "empty", "z", "é", "~null"], [5, 2, 1, 5, 2, 1, 5]))
    level = {s: r["target"] / weights[s] for s, r in per.iterrows() if r["target"] < 2 * r["size"]}
    assert max(level.values()) == pytest.approx(min(level.values()))
    assert all(2 * r["size"] / weights[s] <= min(level.values()) + 1e-6
               for s, r in per.iterrows() if r["target"] == 2 * r["size"])


def test_mix_repeats_rows(spark, no_docs):
    docs = spark.createDataFrame([(i, "w " * (i % 5 + 1), "s" if i % 4 else "t", i) for i in range(200)],
                                 "doc_id long, text string, source string, copies int")
    mix = systematic.mixed(docs).cache()
    out = systematic.repeated(docs, mix)
    assert out.columns == docs.columns
    want = {r["doc_id"]: r["copies"] for r in mix.collect() if r["copies"]}
    assert dict(collections.Counter(r["doc_id"] for r in out.collect())) == want
    assert systematic.mixed(no_docs.selectExpr("doc_id", "text", "'s' source")).count() == 0


def test_hot_source_and_hot_size(spark):
    docs = spark.range(20_000).selectExpr("id doc_id", "'one two three' text", "if(id % 10 < 9, 'hot', 'x') source")
    got = systematic.mixed(docs).groupBy("source").sum("taken").toPandas().set_index("source")["sum(taken)"]
    target = dict(systematic.mixed(docs).select("source", "target").distinct().collect())
    assert all(abs(got[s] - t) <= 3 for s, t in target.items())
