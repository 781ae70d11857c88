"""Language-model scoring with a probabilistic suffix tree.

The model's symbols are the bytes of a document's lower-cased words, joined by
single blanks and ended by a line feed. One pass over the training documents
counts all runs of ``DEPTH`` + 1 symbols (and all words, for the word baseline)
in each task; Spark sums them.

Tree: a context (up to ``DEPTH`` symbols) is retained if its next-symbol
distribution diverges from that of its longest proper suffix by ``MIN_GAIN``
nats over the corpus (or if a retained context ends with it); nothing else
leaves a context or a count out, whatever the corpus' size. A distribution is
smoothed with its suffix's: unseen mass goes to the shorter context, in the end
to all 256 symbols, so every text has a probability. The tree is a written
table of the runs of every depth; tests and smoothing are joins of a depth with
the one below, where a run meets at most 256 longer ones.

Scoring: each symbol is scored by the longest retained suffix of what precedes
it. The probabilities of the most frequent full-depth runs (``RUN_HEAD`` at
most) are broadcast; all other runs of a document are counted in its task and
joined with the table, which also holds the runs of untrained documents. The
head's size changes no score.

Word baseline: words are known by 64-bit hashes. The ``HEAD`` most frequent
words are broadcast; all other words of a document are joined with the word
counts, so no word is left out.

Defined results: a null or empty text is one end token; documents with a null
id train nothing and are not held out; repeated rows count and are scored one
by one; an empty table gives an empty result; without training documents the
model is uniform.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import prepare_python, saved, table
from larder.llm.labelled import held_out

#: Production parameters.
DEPTH = 5
MIN_GAIN = 10.0
HEAD = 1 << 18
RUN_HEAD = 1 << 19
FOLDS, OUT = 5, 1
TABLE_BITS = 21

END = b"\n"
MIX = np.uint64(0x9E3779B97F4A7C15)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def word_hash(words) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64)


def symbol_runs(docs: list[list[bytes]], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """For every symbol of the documents the run of ``depth`` symbols before it
    and itself (low byte last), and the number of symbols of each document."""
    texts = [b" ".join(words) + END for words in docs]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer(END * depth + (END * depth).join(texts), np.uint8).astype(np.uint64)
    runs = np.zeros(len(raw) - depth, np.uint64)
    for j in range(depth + 1):
        runs = (runs << np.uint64(8)) | raw[j:j + len(runs)]
    begin = np.cumsum(sizes + depth) - sizes - depth
    own = np.ones(len(runs), bool)  # not the padding between two documents
    for j in range(depth):
        at = begin[1:] - depth + j
        own[at] = False
    return runs[own], sizes


class Sums:
    """Counts by 64-bit key, merged as sorted arrays."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        both = np.concatenate([self.keys, keys])
        n = np.concatenate([self.counts, counts])
        order = np.argsort(both, kind="stable")
        both, n = both[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, int)
        self.keys, self.counts = both[first], np.add.reduceat(n, first) if len(first) else n


def corpus_counts(docs: DataFrame) -> DataFrame:
    """(kind, key, n, m): words (kind 0, the end token among them) and symbol
    runs (kind 1) of the documents (text), how often they occur in training
    documents (those with ``learn``, if there is such a column) and in all."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {(kind, learn): Sums() for kind in (0, 1) for learn in (True, False)}
        for batch in batches:
            for learn, texts in batch.groupby("learn")["text"]:
                split = [split_words(t) for t in texts]
                known: dict[bytes, int] = {END: 0}
                code = np.fromiter((known.setdefault(w, len(known)) for w in chain.from_iterable(split)), np.int64)
                n = np.bincount(code, minlength=len(known))
                n[0] += len(split)
                sums[0, learn].add(word_hash(known), n)
                sums[1, learn].add(*np.unique(symbol_runs(split)[0], return_counts=True))
        for (kind, learn), s in sums.items():
            for a in range(0, len(s.keys), 100_000):
                n = s.counts[a:a + 100_000]
                yield pd.DataFrame({"kind": np.int32(kind), "key": s.keys[a:a + 100_000].view(np.int64),
                                    "n": n if learn else 0, "m": n})

    learn = F.col("learn") if "learn" in docs.columns else F.lit(True)
    return (docs.select("text", learn.alias("learn")).mapInPandas(count, "kind int, key long, n long, m long")
            .groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("m").alias("m")))


def last(run: str, symbols: Column) -> Column:
    """The last ``symbols`` symbols of a run."""
    return F.col(run).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), symbols * 8) - 1)


def level_counts(runs: DataFrame) -> DataFrame:
    """(depth, run, n, context, all, kinds): how often the runs (key, n) of
    every depth were trained, their context, how often it occurs and its number
    of next symbols."""
    levels = F.explode(F.array(*[
        F.struct(F.lit(d).alias("depth"), last("key", F.lit(d + 1)).alias("run")) for d in range(DEPTH + 1)]))
    sums = saved(runs.select(levels.alias("l"), "n").groupBy("l.depth", "l.run").agg(F.sum("n").alias("n")),
                 "lm-runs")
    own = Window.partitionBy("depth", "context")  # at most 256 rows
    return sums.withColumn("context", F.shiftright("run", 8)).withColumns({
        "all": F.sum("n").over(own), "kinds": F.sum((F.col("n") > 0).cast("int")).over(own)})


def retained(levels: DataFrame) -> DataFrame:
    """(depth, context): contexts that pass the divergence test, and their suffixes."""
    share = F.when(F.col("depth") == 0, (F.col("n") + 0.5) / (F.col("all") + 128)).otherwise(F.col("n") / F.col("all"))
    seen = levels.filter("n > 0")
    below = seen.select((F.col("depth") + 1).alias("depth"), F.col("run").alias("suffix"), share.alias("below"))
    gain = F.sum(F.col("n") * F.log(F.col("n") / F.col("all") / F.col("below")))
    passed = (seen.filter("depth > 0").withColumn("suffix", last("run", F.col("depth"))).join(below, ["depth", "suffix"])
              .groupBy("depth", "context").agg(gain.alias("gain")).filter(F.col("gain") >= MIN_GAIN))
    return (passed.select("context", F.explode(F.sequence(F.lit(1), "depth")).alias("depth"))
            .select("depth", last("context", F.col("depth")).alias("context")).distinct())


def run_scores(runs: DataFrame) -> DataFrame:
    """(run, m, p): log10 probability of the last symbol of every full-depth run
    (key, n, m) after the others."""
    levels = saved(level_counts(runs), "lm-levels")
    tree = saved(levels.join(retained(levels).withColumn("kept", F.lit(True)), ["depth", "context"], "left")
                 .select("depth", "run", "n", "all", "kinds", F.coalesce("kept", F.lit(False)).alias("kept")), "lm-tree")
    p = tree.filter("depth = 0").select("run", F.log10((F.col("n") + 0.5) / (F.col("all") + 128)).alias("p"))
    for d in range(1, DEPTH + 1):
        smoothed = F.log10((F.col("n") + F.col("kinds") * F.pow(F.lit(10.0), "p")) / (F.col("all") + F.col("kinds")))
        p = (tree.filter(F.col("depth") == d).withColumn("suffix", last("run", F.lit(d)))
             .join(p.withColumnRenamed("run", "suffix"), "suffix")
             .select("run", F.when(F.col("kept"), smoothed).otherwise(F.col("p")).alias("p")))
    return runs.select(F.col("key").alias("run"), "m").join(p, "run")


def tree_entries(runs: DataFrame, total: int | None = None) -> pd.DataFrame:
    """(depth, run, n, all, kinds) of a small corpus, for ``Tree``; they do not
    depend on ``total``, the number of its symbols."""
    return (level_counts(runs).filter("n > 0")
            .select(F.col("depth").cast("byte").alias("depth"), "run", "n", "all",
                    F.col("kinds").cast("int").alias("kinds")).toPandas())


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in sorted ``keys``, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return i, keys[i] == wanted


class Head:
    """Scores of some runs, behind a hash table (first come, first placed)."""

    def __init__(self, runs: np.ndarray, p: np.ndarray):
        order = np.argsort(runs)
        self.runs, self.p = runs[order], p[order]
        self.slot_run = np.full(1 << TABLE_BITS, np.uint64(2 ** 64 - 1))
        self.slot_p = np.zeros(1 << TABLE_BITS, np.float64)
        at, first = np.unique(self._slot(self.runs), return_index=True)
        self.slot_run[at], self.slot_p[at] = self.runs[first], self.p[first]

    @staticmethod
    def _slot(runs: np.ndarray) -> np.ndarray:
        return ((runs * MIX) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def score(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores (zero if not here), and the places of runs that are not here."""
        at = self._slot(runs)
        out = self.slot_p[at]
        miss = np.flatnonzero(self.slot_run[at] != runs)
        i, there = find(self.runs, runs[miss])
        out[miss] = np.where(there, self.p[i] if len(self.p) else 0.0, 0.0)
        return out, miss[~there]


class Tree:
    """The model of a small corpus in memory, which the tables are tested
    against: retained contexts by depth, with smoothed distributions."""

    def __init__(self, entries: pd.DataFrame):
        byte = np.uint64(8)
        root = np.full(256, 0.5)
        top = entries[entries["depth"] == 0]
        root[top["run"].to_numpy(np.int64)] += top["n"].to_numpy(float)
        self.root = np.log10(root / root.sum())
        levels = []
        for d in range(1, DEPTH + 1):
            e = entries[entries["depth"] == d].sort_values("run")
            run, n = e["run"].to_numpy(np.int64).astype(np.uint64), e["n"].to_numpy(float)
            levels.append((run, n, e["all"].to_numpy(float), e["kinds"].to_numpy(float)))
        # Divergence tests, longest contexts first: a suffix of a retained one stays.
        share = {0: (np.arange(256, dtype=np.uint64), root / root.sum())}
        for d, (run, n, total, _) in enumerate(levels, 1):
            share[d] = (run, n / np.maximum(total, 1))
        needed = np.zeros(0, np.uint64)
        retained: dict[int, np.ndarray] = {}
        for d in range(DEPTH, 0, -1):
            run, n, _, _ = levels[d - 1]
            i, there = find(share[d - 1][0], run & self._mask(d))
            parent = np.where(there, share[d - 1][1][i] if len(share[d - 1][1]) else 1.0, 1.0)
            context, of = np.unique(run >> byte, return_inverse=True)
            gain = np.bincount(of, n * np.log(np.maximum(share[d][1], 1e-300) / np.maximum(parent, 1e-300)),
                               len(context))
            keep = context[(gain >= MIN_GAIN) | np.isin(context, needed)]
            retained[d] = keep
            needed = np.unique(keep & self._mask(d - 1)) if d > 1 else needed
        self.levels = []
        for d in range(1, DEPTH + 1):
            run, n, total, kinds = levels[d - 1]
            inside = np.isin(run >> byte, retained[d])
            run, n, total, kinds = run[inside], n[inside], total[inside], kinds[inside]
            context, first, of = np.unique(run >> byte, return_index=True, return_inverse=True)
            seen = np.bincount(of, n, len(context))
            rest = (total[first] - seen + kinds[first]) / (total[first] + kinds[first])
            below = 10 ** self._walk(run & self._mask(d), d - 1)
            p = n / (total + kinds) + rest[of] * below
            self.levels.append((run, np.log10(p), context, np.log10(np.maximum(rest, 1e-300))))
        self.head = Head(levels[-1][0], self._walk(levels[-1][0], DEPTH))

    @staticmethod
    def _mask(d: int) -> np.uint64:
        """Keeps the last ``d`` symbols of a run (itself included)."""
        return np.uint64((1 << 8 * d) - 1)

    def _walk(self, runs: np.ndarray, depth: int) -> np.ndarray:
        """log10 probability of the last symbol of each run after the others,
        looking back ``depth`` symbols at most."""
        out = self.root[(runs & np.uint64(255)).astype(np.int64)]
        for d in range(1, depth + 1):
            run, p, context, rest = self.levels[d - 1]
            own = runs & self._mask(d + 1)
            i, hit = find(run, own)
            j, known = find(context, own >> np.uint64(8))
            out = np.where(hit, p[i] if len(p) else 0.0, np.where(known, out + (rest[j] if len(rest) else 0.0), out))
        return out

    def score(self, runs: np.ndarray) -> np.ndarray:
        out, miss = self.head.score(runs)
        out[miss] = self._walk(runs[miss], DEPTH)
        return out


#: The head this Python worker has built last.
_HEADS: dict[str, Head] = {}


def frequent(words: DataFrame, most: int, count: str = "n") -> DataFrame:
    """The most frequent words or runs, at most ``most``: whole classes of
    counts (eighths of a power of two), from the top."""
    size_class = F.floor(F.log2(count) * 8)
    classes = words.groupBy(size_class.alias("c")).agg(F.count(F.lit(1)).alias("k")).collect()  # a few hundred rows
    least, total = None, 0
    for r in sorted(classes, key=lambda r: -r["c"]):
        total += r["k"]
        if total > most:
            break
        least = r["c"]
    return words.filter(F.lit(False) if least is None else size_class >= least)


def score_documents(docs: DataFrame, train: DataFrame) -> DataFrame:
    """``docs`` (doc_id, held_out, text) scored by a model of ``train`` (text):
    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    return score_counted(docs, train.select("text", F.lit(True).alias("learn")).union(
        docs.select("text", F.lit(False))))


def score_counted(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """As ``score_documents``; ``texts`` (text, learn) has the training
    documents and the other ones of ``docs``."""
    spark = docs.sparkSession
    prepare_python(spark)
    counts = saved(corpus_counts(texts), "lm-counts")
    words, runs = counts.filter("kind = 0 AND n > 0").select("key", "n"), counts.filter("kind = 1")
    size = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    n_train, n_kinds = size[0] or 0, size[1]
    log_all = float(np.log10(n_train + 0.5 * (n_kinds + 1)))
    scores = saved(run_scores(runs), "lm-scores")
    some = frequent(scores, RUN_HEAD, "m").select("run", "p").toPandas()  # at most RUN_HEAD rows of two numbers
    head = frequent(words, HEAD).toPandas()  # at most HEAD rows of two numbers
    keys = head["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    name = uuid.uuid4().hex
    model = spark.sparkContext.broadcast((some["run"].to_numpy(np.int64).view(np.uint64), some["p"].to_numpy(float),
                                          keys[order], head["n"].to_numpy(np.int64)[order]))
    del some, head
    # Without a word beyond the head none is looked up.
    whole = len(keys) == n_kinds

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head_runs, head_p, head_keys, head_counts = model.value
        likely = _HEADS.get(name)
        if likely is None:
            _HEADS.clear()
            likely = _HEADS[name] = Head(head_runs, head_p)
        rid = TaskContext.get().partitionId() << 33
        for batch in batches:
            split = [split_words(t) for t in batch["text"]]
            if not split:
                continue
            known: dict[bytes, int] = {}
            code = np.fromiter((known.setdefault(w, len(known)) for w in chain.from_iterable(split)), np.int64)
            hashes = np.append(word_hash(known), word_hash([END]))
            i, there = find(head_keys, hashes)
            log_count = np.where(there, np.log10((head_counts[i] if len(head_counts) else 0) + 0.5), np.log10(0.5))
            lengths = np.fromiter(map(len, split), np.int64, len(split))
            doc = np.repeat(np.arange(len(split)), lengths)
            n_known = np.bincount(doc, there[code], len(split)).astype(np.int64) + int(there[-1])
            base = np.bincount(doc, np.where(there, log_count, 0.0)[code], len(split)) + log_count[-1]
            if whole:  # what is not in the head was never seen
                base += np.bincount(doc, np.where(there, 0.0, np.log10(0.5))[code], len(split))
                tails = [[] for _ in split]
            else:
                out = ~there[code]
                pair, n = np.unique(doc[out] * np.int64(len(known) + 1) + code[out], return_counts=True)
                of, word = pair // (len(known) + 1), pair % (len(known) + 1)
                cuts = np.searchsorted(of, np.arange(1, len(split)))
                both = np.stack([hashes[word].view(np.int64), n.astype(np.int64)], axis=1)
                tails = [x.reshape(-1) for x in np.split(both, cuts)]
            grams, sizes = symbol_runs(split)
            ends = np.cumsum(sizes)
            p, miss = likely.score(grams)
            total = np.concatenate([[0.0], np.cumsum(p)])
            # Runs beyond the head, counted by document.
            of = np.searchsorted(ends, miss, "right")
            rare = grams[miss]
            by = np.lexsort((rare, of))
            of, rare = of[by], rare[by]
            new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (rare[1:] != rare[:-1])])
                                 if len(of) else np.zeros(0, bool))
            cuts = np.searchsorted(of[new], np.arange(1, len(split)))
            yield pd.DataFrame({
                "rid": np.arange(rid, rid + len(split)), "doc_id": batch["doc_id"],
                "held_out": batch["held_out"], "n_tokens": lengths + 1, "known": n_known, "base": base,
                "score": total[ends] - total[ends - sizes], "tail": tails,
                "run": np.split(rare[new].view(np.int64), cuts),
                "times": np.split(np.diff(np.append(new, len(of))), cuts)})
            rid += len(split)

    rows = saved(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "held_out", "text").mapInPandas(
        score, "rid long, doc_id string, held_out boolean, n_tokens long, known long, base double, score double, "
               "tail array<long>, run array<long>, times array<long>"), "lm-rows")
    # Words beyond the head: one row per document and word, joined by hash.
    pairs = F.transform(F.sequence(F.lit(0), F.size("tail") - 2, F.lit(2)), lambda i: F.struct(
        F.get("tail", i).alias("key"), F.get("tail", i + 1).alias("m")))
    tail = (rows.filter(F.size("tail") > 0).select("rid", F.explode(pairs).alias("w"))
            .select("rid", F.col("w.key").alias("key"), F.col("w.m").alias("m")))
    looked = (tail.join(words, "key", "left").groupBy("rid").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("m")).otherwise(0)).alias("_known"),
        F.sum(F.col("m") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("_base")))
    # Runs beyond the head: likewise, joined by themselves.
    rare = (rows.select("rid", F.explode(F.arrays_zip("run", "times")).alias("r"))
            .select("rid", "r.run", "r.times").join(scores.select("run", "p"), "run")
            .groupBy("rid").agg(F.sum(F.col("times") * F.col("p")).alias("_score")))
    return rows.drop("tail", "run", "times").join(looked, "rid", "left").join(rare, "rid", "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens", (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0)) - F.col("n_tokens") * log_all).alias("base_score"),
        (F.col("score") + F.coalesce("_score", F.lit(0.0))).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: log10 probability of every document."""
    out = held_out(folds=FOLDS, out=OUT)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", out.alias("held_out"))
    return score_counted(docs, docs.select("text", (~out & F.col("doc_id").isNotNull()).alias("learn")))
