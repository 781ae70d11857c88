"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes
log-count ratios, trained on labelled text.

Features are distinct character n-grams (3 to 5 code points of the lower-cased
text, blanks included, so word starts count). Training, on at most
``TRAIN_ROWS`` labelled documents:

1. the documents with each n-gram are counted exactly per class (a task merges its
   counts and sends them on when it holds ``GRAMS_HELD`` of them);
2. every n-gram whose log-count ratio r passes the tests is a feature (the bounded
   training rows bound them);
3. a logistic regression is fitted on features of value r (present) or 0.

Scoring is one pass over whole texts: a bit table discards almost all n-grams,
the rest is looked up exactly.

Defined results: a null or empty text has no feature and gets the intercept's
score; a null id is never held out nor trained on; repeated rows repeat their
score; without labels of both classes the score is the share of toxic labels
(0.5 each as prior); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import prepare_python, saved, table
from larder.llm.labelled import held_out, training_rows

#: Production parameters.
TRAIN_ROWS = 20_000
SIZES = (3, 4, 5)
#: Size of the bit table that the scoring pass looks n-grams up in first.
BUCKET_BITS = 20
GRAMS_HELD = 1_000_000
MIN_DOCUMENTS = 4
MIN_Z = 2.5
MIN_RATIO = 1.0
PRIOR = 0.5
L2 = 1e-4
STEPS = 400
THRESHOLD = 0.3

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts (lower case, single blanks, blank-padded, each
    ended by a zero) and the texts' bounds."""
    clean = [f" {' '.join((t or '').lower().replace(chr(0), ' ').split())} \0" for t in texts]
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, clean), np.int64, len(clean)))])
    return np.frombuffer("".join(clean).encode("utf-32-le", "surrogatepass"), np.uint32), bounds


def gram_hashes(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, hashes) of the n-grams of each size, none across two texts."""
    c = points.astype(np.uint64)
    end = np.flatnonzero(points == 0)
    for n in SIZES:
        if len(c) < n:
            continue
        h = np.full(len(c) - n + 1, n, np.uint64)
        for j in range(n):
            h = (h + c[j:len(c) - n + 1 + j]) * MULTIPLIER
        h ^= h >> np.uint64(31)
        h *= MULTIPLIER
        ok = np.ones(len(h), bool)
        for j in range(n):
            at = end - j
            ok[at[(at >= 0) & (at < len(ok))]] = False
        at = np.flatnonzero(ok)
        yield at, h[at]


def _distinct(docs: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, key) pairs."""
    order = np.lexsort((keys, docs))
    docs, keys = docs[order], keys[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1])
    return docs[new], keys[new]


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def log_ratio(pos, neg, n_pos: int, n_neg: int) -> tuple[np.ndarray, np.ndarray]:
    """Naive Bayes log-count ratio and its z value."""
    r = np.log((pos + PRIOR) / (n_pos + 2 * PRIOR)) - np.log((neg + PRIOR) / (n_neg + 2 * PRIOR))
    return r, r / np.sqrt(1 / (pos + PRIOR) + 1 / (neg + PRIOR))


def _kept(pos, neg, n_pos: int, n_neg: int) -> np.ndarray:
    r, z = log_ratio(pos, neg, n_pos, n_neg)
    return (pos + neg >= MIN_DOCUMENTS) & (np.abs(z) >= MIN_Z) & (np.abs(r) >= MIN_RATIO)


def gram_counts(rows: DataFrame) -> DataFrame:
    """(hash, pos, neg): toxic and other documents with each n-gram."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, fresh, waiting = [np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)], [], 0

        def merged() -> list[np.ndarray]:
            grams = np.concatenate([held[0], *(g for g, _ in fresh)])
            toxic = np.concatenate([held[1], *(np.full(len(g), float(y)) for g, y in fresh)])
            other = np.concatenate([held[2], *(np.full(len(g), float(1 - y)) for g, y in fresh)])
            keys, of = np.unique(grams, return_inverse=True)
            return [keys, np.bincount(of, toxic, len(keys)), np.bincount(of, other, len(keys))]

        def frame() -> pd.DataFrame:
            return pd.DataFrame({"hash": held[0].view(np.int64), "pos": held[1].astype(np.int64),
                                 "neg": held[2].astype(np.int64)})

        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                found = [h for _, h in gram_hashes(code_points([text])[0])]
                grams = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]))
                fresh.append((grams, int(label)))
                waiting += len(grams)
                if waiting >= GRAMS_HELD:
                    held, fresh, waiting = merged(), [], 0
                    if len(held[0]) >= GRAMS_HELD:
                        yield frame()
                        held = [a[:0] for a in held]
        held, fresh = merged(), []
        yield frame()

    return (rows.mapInPandas(count, "hash long, pos long, neg long").groupBy("hash")
            .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def find_grams(texts: list[str | None], table_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, n-gram hash) pairs whose bucket is marked."""
    points, bounds = code_points(texts)
    at, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for where, h in gram_hashes(points):
        hit = np.flatnonzero(table_[_bucket(h)])
        at.append(where[hit])
        hashes.append(h[hit])
    doc = np.searchsorted(bounds, np.concatenate(at), "right") - 1
    return _distinct(doc, np.concatenate(hashes))


def fit_logistic(rows: np.ndarray, cols: np.ndarray, value: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2 logistic regression on a sparse matrix
    with ``value[col]`` at (row, col), by accelerated gradient descent."""
    n, k = len(y), len(value)
    x = value[cols]
    per_row = np.bincount(rows, x * x, n)
    rate = 1.0 / (0.25 * (1 + float(per_row.max(initial=0))) + L2)
    w = np.zeros(k + 1)
    prior = (y.sum() + 0.5) / (n + 1)
    w[k] = np.log(prior / (1 - prior))
    ahead, t = w.copy(), 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, x * ahead[cols], n) + ahead[k], -30, 30)))
        g = np.append(np.bincount(cols, x * (p - y)[rows], k), (p - y).sum()) / n
        g[:k] += L2 * ahead[:k]
        new = ahead - rate * n / max(1, n) * g
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w[:k], float(w[k])


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """Feature hashes (sorted), their weights times ratios, and the intercept."""
    spark = docs.sparkSession
    prepare_python(spark)
    rows = saved(training_rows(docs, labels, "toxic", TRAIN_ROWS), "toxic-train")
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = n.get(1, 0), n.get(0, 0)
    prior = (n_pos + 0.5) / (n_pos + n_neg + 1)
    empty = {"hash": np.zeros(0, np.uint64), "weight": np.zeros(0), "bias": float(np.log(prior / (1 - prior)))}
    if not n_pos or not n_neg:
        return empty
    counts = gram_counts(rows).filter(F.col("pos") + F.col("neg") >= MIN_DOCUMENTS)
    # As in _kept, but in Spark: only features far from zero come back.
    p = (F.col("pos") + PRIOR) / (n_pos + 2 * PRIOR)
    q = (F.col("neg") + PRIOR) / (n_neg + 2 * PRIOR)
    z = F.log(p / q) / F.sqrt(1 / (F.col("pos") + PRIOR) + 1 / (F.col("neg") + PRIOR))
    best = (counts.withColumns({"r": F.log(p / q), "z": F.abs(z)})
            .filter((F.col("z") >= MIN_Z) & (F.abs("r") >= MIN_RATIO))
            .select("hash", "r").toPandas())
    if not len(best):
        return empty
    hashes = best["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hashes, ratio = hashes[order], best["r"].to_numpy()[order]

    def design(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        only = np.zeros(1 << BUCKET_BITS, bool)
        only[_bucket(hashes)] = True
        for batch in batches:
            doc, h = find_grams(batch["text"].tolist(), only)
            i = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[i] == h
            cuts = np.searchsorted(doc[hit], np.arange(1, len(batch)))
            yield pd.DataFrame({"label": batch["label"], "features": np.split(i[hit].astype(np.int32), cuts)})

    # At most TRAIN_ROWS rows of small integers.
    matrix = rows.mapInPandas(design, "label int, features array<int>").toPandas()
    sizes = matrix["features"].map(len).to_numpy()
    weight, bias = fit_logistic(np.repeat(np.arange(len(matrix)), sizes),
                                np.concatenate(matrix["features"].tolist()).astype(np.int64), ratio,
                                matrix["label"].to_numpy(float))
    return {"hash": hashes, "weight": weight * ratio, "bias": bias}


def score_column(model: dict, text):
    """Probability that a text is toxic."""
    hashes, weight, bias = model["hash"], model["weight"], model["bias"]

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        only = np.zeros(1 << BUCKET_BITS, bool)
        only[_bucket(hashes)] = True
        for texts in batches:
            total = np.full(len(texts), bias)
            if len(hashes):
                doc, h = find_grams(texts.tolist(), only)
                i = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                hit = hashes[i] == h
                total += np.bincount(doc[hit], weight[i[hit]], len(texts))
            yield pd.Series(1 / (1 + np.exp(-np.clip(total, -500, 500))))
    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    model = train(docs, labels)
    prepare_python(docs.sparkSession)
    return docs.withColumn("score", score_column(model, F.col("text"))).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: toxicity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")
