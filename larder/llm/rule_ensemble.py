"""Quality classifier: a sparse ensemble of rules over document statistics.

Statistics are Spark column expressions. On at most ``TRAIN_ROWS`` labelled
documents small boosted trees are grown over them; every path from a root is a
conjunctive rule ("symbol share > a and distinct words <= b"); a logistic
regression with a lasso penalty keeps few rules; and the kept rules are
compiled back into one Spark column expression, so scoring is native.

Defined results: a null or empty text has zero statistics and is scored like
any other; null ids are neither held out nor trained on; repeated rows repeat
their score; without labels of both classes every score is the share of good
labels (0.5 each as prior); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import let, prepare_python, saved, table, words_of
from larder.llm.labelled import held_out, training_rows

#: Production parameters.
TRAIN_ROWS = 20_000
TREES = 30
DEPTH = 3
CUTS = 32
MIN_LEAF = 10
SHRINK = 0.3
LASSO = 2e-3
STEPS = 600
THRESHOLD = 0.7
SEED = 9

#: Statistics in the order of the training matrix.
STATISTICS = ("n_words", "word_length", "distinct_share", "symbol_share", "upper_share", "digit_share",
              "mark_share", "doubled_share", "bar_share", "line_words", "repeated_lines", "unended_lines")


def statistics(text: Column) -> Column:
    """A struct of the document statistics, each a finite double."""
    t = F.coalesce(text, F.lit(""))

    def share(pattern: str, chars: Column) -> Column:
        return F.regexp_count(t, F.lit(pattern)) / F.greatest(chars, F.lit(1))

    def of_words(w: Column) -> Column:
        n = F.size(w)
        return F.struct(
            n.cast("double").alias("n_words"),
            (F.length(F.array_join(w, "")) / F.greatest(n, F.lit(1))).alias("word_length"),
            (F.size(F.array_distinct(w)) / F.greatest(n, F.lit(1))).alias("distinct_share"))

    def of_lines(lines: Column) -> Column:
        n = F.size(lines)
        some = F.greatest(n, F.lit(1))
        ended = F.size(F.filter(lines, lambda x: x.rlike(r"[.!?…][\x20\x09-\x0D]*\z")))
        return F.struct(n.cast("double").alias("n_lines"),
                        ((n - F.size(F.array_distinct(lines))) / some).alias("repeated_lines"),
                        ((n - ended) / some).alias("unended_lines"))

    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(words_of(t), lambda w: let(of_words(w), lambda a: let(let(lines, of_lines), lambda b: let(
        F.length(t), lambda chars: F.struct(
            a["n_words"].alias("n_words"), a["word_length"].alias("word_length"),
            a["distinct_share"].alias("distinct_share"), share(r"[#*$%&<>]", chars).alias("symbol_share"),
            share(r"\p{Lu}", chars).alias("upper_share"), share(r"[0-9]", chars).alias("digit_share"),
            share(r"[.,;:!?]", chars).alias("mark_share"), share(r"[!?]{2}", chars).alias("doubled_share"),
            share(r"\|", chars).alias("bar_share"),
            (a["n_words"] / F.greatest(b["n_lines"], F.lit(1.0))).alias("line_words"),
            b["repeated_lines"].alias("repeated_lines"), b["unended_lines"].alias("unended_lines"))))))


# A rule is a tuple of conditions (statistic number, cut, above?).
Rule = tuple[tuple[int, float, bool], ...]


def grow(x: np.ndarray, bins: np.ndarray, cuts: list[np.ndarray], target: np.ndarray,
         columns: np.ndarray) -> tuple[list[Rule], np.ndarray]:
    """A regression tree: its paths (every node but the root) and its fit."""
    paths: list[Rule] = []
    fit = np.zeros(len(target))

    def split(rows: np.ndarray, path: Rule) -> None:
        y = target[rows]
        if path:
            paths.append(path)
        best = (1e-9, None, None)
        if len(path) < DEPTH and len(rows) >= 2 * MIN_LEAF:
            total, n = y.sum(), len(rows)
            for c in columns:
                k = len(cuts[c])
                count = np.cumsum(np.bincount(bins[rows, c], minlength=k + 1))[:k]
                left = np.cumsum(np.bincount(bins[rows, c], y, k + 1))[:k]
                right, rest = total - left, n - count
                ok = (count >= MIN_LEAF) & (rest >= MIN_LEAF)
                gain = np.where(ok, left ** 2 / np.maximum(count, 1) + right ** 2 / np.maximum(rest, 1), -np.inf)
                gain = gain - total ** 2 / n
                if k and gain.max() > best[0]:
                    best = (float(gain.max()), c, int(gain.argmax()))
        if best[1] is None:
            fit[rows] = y.mean()
            return
        _, c, i = best
        low = bins[rows, c] <= i
        cut = float(cuts[c][i])
        split(rows[low], (*path, (int(c), cut, False)))
        split(rows[~low], (*path, (int(c), cut, True)))

    split(np.arange(len(target)), ())
    return paths, fit


def extract_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Distinct paths of boosted trees on random halves of the statistics."""
    rng = np.random.default_rng(SEED)
    cuts = [np.unique(np.quantile(x[:, c], np.linspace(0, 1, CUTS + 1)[1:-1])) for c in range(x.shape[1])]
    bins = np.stack([np.searchsorted(k, x[:, c], "left") for c, k in enumerate(cuts)], axis=1)
    mean = (y.sum() + 0.5) / (len(y) + 1)
    f = np.full(len(y), np.log(mean / (1 - mean)))
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        columns = rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False)
        p = 1 / (1 + np.exp(-f))
        paths, fit = grow(x, bins, cuts, y - p, columns)
        rules.update(dict.fromkeys(paths))
        f += SHRINK * fit / 0.25
    return list(rules)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c, cut, above in rule:
        out &= (x[:, c] > cut) == above
    return out


def fit_lasso(z: np.ndarray, y: np.ndarray, penalty: float = LASSO) -> tuple[np.ndarray, float]:
    """Lasso logistic regression on 0/1 columns by accelerated proximal steps."""
    n, k = z.shape
    mean = (y.sum() + 0.5) / (n + 1)
    w, bias = np.zeros(k), float(np.log(mean / (1 - mean)))
    v = np.ones(k)  # largest eigenvalue by power iteration
    for _ in range(20):
        v = z.T @ (z @ v)
        v /= max(float(np.linalg.norm(v)), 1e-12)
    rate = 1 / (0.25 * (float(np.linalg.norm(z @ v)) ** 2 / n + 1) * 1.05)
    a, ab, t = w.copy(), bias, 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(z @ a + ab, -30, 30)))
        step = a - rate * (z.T @ (p - y)) / n
        new = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0)
        new_b = ab - rate * float((p - y).mean())
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        a, ab = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - bias)
        w, bias, t = new, new_b, t_new
    return w, bias


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple[Rule, float]], float]:
    """Kept rules with their weights, and the intercept."""
    prepare_python(docs.sparkSession)
    rows = saved(training_rows(docs, labels, "quality", TRAIN_ROWS)
                 .select("label", statistics(F.col("text")).alias("s")).select("label", "s.*"), "quality-train")
    data = rows.orderBy(*rows.columns).toPandas()  # at most TRAIN_ROWS rows of a dozen numbers
    y = data["label"].to_numpy(float)
    mean = (y.sum() + 0.5) / (len(y) + 1)
    if not 0 < y.sum() < len(y):
        return [], float(np.log(mean / (1 - mean)))
    x = data[list(STATISTICS)].to_numpy(float)
    rules = extract_rules(x, y)
    if not rules:
        return [], float(np.log(mean / (1 - mean)))
    weights, bias = fit_lasso(np.stack([holds(r, x) for r in rules], axis=1).astype(float), y)
    return [(r, float(w)) for r, w in zip(rules, weights) if w], bias


def compiled(model: tuple[list[tuple[Rule, float]], float], stats: Column) -> Column:
    """The model as one column expression over a struct of statistics."""
    rules, bias = model
    total = F.lit(bias)
    for rule, weight in rules:
        test = F.lit(True)
        for c, cut, above in rule:
            value = stats[STATISTICS[c]]
            test = test & ((value > cut) if above else (value <= cut))
        total = total + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    model = train(docs, labels)
    # The row travels as one struct, so its columns may have any names.
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), statistics(F.col("text")).alias("_stats"))
    return (rows.select("_doc", compiled(model, F.col("_stats")).alias("score"))
            .select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns if c not in ("score", "predicted")],
                    "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: quality of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")
