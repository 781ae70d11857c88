"""Classifiers, language model, pipeline."""

import math
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from larder.llm import decontaminate, rule_ensemble, simhash, suffix_tree, toxicity
from larder.llm.common import saved, table
from llm_fixtures import SF001, SF01, no_docs, odd_docs  # noqa: F401

FOLD = lambda d, n: zlib.crc32(str(d).encode()) % n


def labelled(spark, got, label):
    m = got.merge(spark.read.parquet(f"{SF01}/labels.parquet").toPandas(), on="doc_id")
    return m[m["held_out"]], label


def test_toxicity_on_held_out_documents(spark):
    got = toxicity.query(spark, SF01).toPandas()
    assert (got["held_out"] == got["doc_id"].map(lambda d: FOLD(d, 4) == 2)).all()
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()
    m, _ = labelled(spark, got, "toxic")
    assert (m["predicted"] == m["toxic"]).mean() > 0.94


def test_quality_on_held_out_documents(spark):
    q = rule_ensemble.query(spark, SF01)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    m, _ = labelled(spark, q.toPandas(), "quality")
    assert (m["predicted"] == m["quality"]).mean() > 0.97


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (rule_ensemble, "quality")])
def test_classifiers_on_odd_rows(spark, odd_docs, no_docs, module, label):
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    wide = docs.union(odd_docs.select((odd_docs["doc_id"] + 10 ** 6).alias("doc_id"), "text"))
    got = module.score_documents(wide, labels).toPandas()
    assert len(got) == docs.count() + odd_docs.count() and got["score"].between(0, 1).all()
    none = labels.filter("doc_id < 0")
    assert module.score_documents(no_docs, none).count() == 0
    flat = module.score_documents(odd_docs, none).select("score").distinct().collect()
    assert [r["score"] for r in flat] == [0.5]


@pytest.mark.parametrize("held", [toxicity.GRAMS_HELD, 3000])
def test_toxicity_keeps_every_passing_ngram(spark, monkeypatch, held):
    monkeypatch.setattr(toxicity, "GRAMS_HELD", held)
    rng = np.random.default_rng(0)
    words = ["".join(w) for w in rng.choice(list("abcdefghijklmnopqrstuvwxyz"), (2400, 7))]
    rows = [(i, " ".join(rng.choice(words[i % 2::2], 220)), i % 2) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([r[::2] for r in rows], "doc_id long, toxic int"))
    learned = [r for r in rows if FOLD(r[0], 4) != 2]
    count = {1: Counter(), 0: Counter()}
    for _, text, label in learned:
        count[label].update({int(h) for _, hs in toxicity.gram_hashes(toxicity.code_points([text])[0]) for h in hs})
    n = Counter(r[2] for r in learned)
    grams = sorted(count[0] | count[1])
    pos, neg = (np.array([count[k][g] for g in grams]) for k in (1, 0))
    want = [g for g, ok in zip(grams, toxicity._kept(pos, neg, n[1], n[0])) if ok]
    assert len(want) > 4096
    assert model["hash"].tolist() == want
    # Scores from the definition: distinct n-grams of the whole text, looked up one by one.
    weight = dict(zip(model["hash"].tolist(), model["weight"].tolist()))
    texts = [rows[2][1], rows[3][1] + " " + rows[4][1], rows[2][1] * 2, "", None, "ab", words[0]]
    probe = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r[0]: r[1] for r in probe.select("doc_id", toxicity.score_column(model, "text")).collect()}
    for i, text in enumerate(texts):
        found = {int(h) for _, hs in toxicity.gram_hashes(toxicity.code_points([text])[0]) for h in hs}
        total = model["bias"] + sum(weight.get(h, 0.0) for h in found)
        assert got[i] == pytest.approx(1 / (1 + np.exp(-total)), rel=1e-9)


def test_lasso_keeps_few_rules():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 12))
    y = ((x[:, 3] > 0.8) & (x[:, 5] < 0.5) | (x[:, 1] < 0.1)).astype(float)
    rules = rule_ensemble.extract_rules(x, y)
    z = np.stack([rule_ensemble.holds(r, x) for r in rules], axis=1).astype(float)
    w, b = rule_ensemble.fit_lasso(z, y)
    assert 0 < (w != 0).sum() < len(rules)
    assert (((z @ w + b) > 0) == y).mean() > 0.97


@pytest.mark.parametrize("head", [1 << 20, 2000])
def test_language_model_base(spark, head, monkeypatch):
    monkeypatch.setattr(suffix_tree, "HEAD", head)
    got = suffix_tree.query(spark, SF01).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF01}/documents.parquet").toPandas()
    count = Counter()
    for d, t in zip(docs["doc_id"], docs["text"]):
        if FOLD(d, 5) != 1:
            count.update([*t.encode().lower().split(), b"\n"])
    total, kinds = sum(count.values()), len(count)
    for d, t in zip(docs["doc_id"], docs["text"]):
        words = [*t.encode().lower().split(), b"\n"]
        row = got.loc[d]
        assert row["held_out"] == (FOLD(d, 5) == 1) and row["n_tokens"] == len(words) and row["train_tokens"] == total
        assert row["n_known"] == sum(count[w] > 0 for w in words)
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words)
        assert abs(base - row["base_score"]) < 1e-6 * max(1, abs(base))
    assert (got["score"] < 0).all() and np.isfinite(got["score"]).all()


def test_tree_is_a_distribution_and_its_table_agrees(spark):
    docs = table(spark, SF01, "documents").select("text")
    counts = suffix_tree.corpus_counts(docs)
    tree = suffix_tree.Tree(suffix_tree.tree_entries(counts.filter("kind = 1"), 2_000_000))
    rng = np.random.default_rng(0)
    runs = suffix_tree.symbol_runs([suffix_tree.split_words(r["text"]) for r in docs.limit(50).collect()])[0]
    for run in rng.choice(runs, 50):
        every = (run & ~np.uint64(255)) | np.arange(256, dtype=np.uint64)
        assert abs((10 ** tree.score(every)).sum() - 1) < 1e-6
    assert np.allclose(tree.score(runs), tree._walk(runs, suffix_tree.DEPTH))


def test_language_model_keeps_rare_contexts_of_a_large_corpus(spark, monkeypatch):
    rare = spark.createDataFrame([(i, False, "xqzjv kwxyz") for i in range(2)], "doc_id long, held_out boolean, text string")
    much = spark.range(30).selectExpr("repeat('ab cd ', 200000) AS text")  # 36 million symbols
    other = spark.createDataFrame([(9, True, "xqzjw ab cq \u6f22")], rare.schema)
    got = suffix_tree.score_documents(rare.union(other), much.union(rare.select("text"))).toPandas().set_index("doc_id")
    # Two occurrences tell what follows: far from the 12 * log10(1 / 18,000,000) of single symbols.
    assert got.loc[0, "score"] == got.loc[1, "score"] > -25
    train = spark.createDataFrame([("ab cd " * 500,), *[("xqzjv kwxyz",)] * 2], "text string")
    counts = suffix_tree.corpus_counts(train)
    tree = suffix_tree.Tree(suffix_tree.tree_entries(counts.filter("kind = 1")))
    for head in (1 << 19, 8, 0):
        monkeypatch.setattr(suffix_tree, "RUN_HEAD", head)
        got = suffix_tree.score_documents(rare.union(other), train).toPandas().set_index("doc_id")
        for r in rare.union(other).collect():
            runs = suffix_tree.symbol_runs([suffix_tree.split_words(r["text"])])[0]
            assert abs(got.loc[r["doc_id"], "score"] - tree.score(runs).sum()) < 1e-9


def test_language_model_on_odd_rows(spark, odd_docs, no_docs):
    out = odd_docs.selectExpr("doc_id", "false AS held_out", "text")
    got = suffix_tree.score_documents(out, odd_docs.select("text")).toPandas()
    assert len(got) == odd_docs.count() and np.isfinite(got["score"]).all()
    assert suffix_tree.score_documents(no_docs.selectExpr("doc_id", "false AS held_out", "text"), no_docs).count() == 0
    untrained = suffix_tree.score_documents(out, no_docs.select("text")).toPandas()
    assert (untrained["n_known"] == 0).all() and np.isfinite(untrained["base_score"]).all()


def test_pipeline_stages(spark):
    docs = table(spark, SF01, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = saved(stage(spark, docs, SF01), "t-pipeline")
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        seen[name] = (docs.toPandas(), out.toPandas())
        docs = out
    labels = spark.read.parquet(f"{SF01}/labels.parquet").toPandas().set_index("doc_id")
    before, after = seen["toxicity"]
    gone = set(before["doc_id"]) - set(after["doc_id"])
    known = [d for d in gone if d in labels.index]
    assert np.mean([labels.loc[d, "toxic"] for d in known]) > 0.9
    before, after = seen["quality_rules"]
    clean = [d for d in before["doc_id"] if d in labels.index and labels.loc[d, "quality"] == 1
             and len(before.set_index("doc_id").loc[d, "text"].split()) >= 50]
    assert set(clean) <= set(after["doc_id"])
    before, after = seen["simhash_near_dedup"]
    classes = simhash.near_duplicates(spark.createDataFrame(before)).toPandas()
    assert sorted(after["doc_id"]) == sorted(classes["component_id"].unique())
    before, after = seen["decontamination"]
    bad = decontaminate.overlaps(spark.createDataFrame(before), table(spark, SF01, "benchmark")).toPandas()
    assert set(before["doc_id"]) - set(after["doc_id"]) == set(bad["doc_id"])
    before, after = seen["best_fit_packing"]
    assert set(after["doc_id"]) == set(before["doc_id"])


def test_pipeline_on_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[1:]:
            docs = saved(stage(spark, docs, SF001), "t-pipeline")
        assert docs.count() == 0  # nothing here is fifty words of prose
