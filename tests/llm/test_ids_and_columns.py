"""Ids beyond 2**53 beside a null, columns of any name, bounded training rows,
short and unspaced benchmark items."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from larder.llm import decontaminate, labelled, packing, pfor, rule_ensemble, simhash, suffix_tree, warc
from larder.llm.common import shared_path
from larder.llm.tokens import tokenizer_path

A, B = 2 ** 60 + 1, 2 ** 60 + 3
PROSE = " ".join(f"Sentence number {i} tells of harbour lights and quiet boats beyond the pier." for i in range(12))


def wide(spark, columns="doc_id long, text string"):
    """Two wide ids and a null one in one partition, so in one batch."""
    return spark.createDataFrame([(A, PROSE), (None, "no id"), (B, PROSE + " More.")], columns).coalesce(1)


def ids(df, column="doc_id"):
    return {r[column] for r in df.select(column).collect()}


def test_token_files_keep_ids(spark):
    files = pfor.write_files(wide(spark), shared_path(spark, "t"), tokenizer_path())
    assert ids(pfor.read_files(spark, files)) == {A, B, None}


def test_archives_keep_ids(spark):
    pages = spark.createDataFrame([(A, "u", "same"), (None, None, "x"), (B, "u", "same"), (A - 8, "v", "same")],
                                  "page_id long, url string, html string").coalesce(1)
    got = warc.resolved(warc.read_archives(spark, warc.write_archives(pages, shared_path(spark, "w"))))
    rows = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in got.collect()}
    assert rows == {A: ("revisit", B), A - 8: ("revisit", B), B: ("response", None), None: ("response", None)}


def test_decontamination_keeps_ids(spark):
    bench = spark.createDataFrame([(A, PROSE), (None, "no item"), (B, "of tokens " * 9)], "item_id long, text string").coalesce(1)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(wide(spark), bench).collect()}
    assert got == {(A, A), (B, A)}


def test_language_model_keeps_ids(spark):
    docs = wide(spark).select("doc_id", "text", F.lit(False).alias("held_out"))
    assert ids(suffix_tree.score_counted(docs, docs.select("text", F.lit(True).alias("learn")))) == {A, B, None}


def test_packing_keeps_ids(spark):
    assert ids(packing.pack_documents(wide(spark), tokenizer_path())) == {A, B, None}


def test_short_and_unspaced_items(spark):
    items = [(1, "What is two plus two?"), (2, "水的化学式是什么"), (3, "中国的首都是哪座城市它位于哪里请回答"), (4, "Yes")]
    docs = [(1, "He asked: what is TWO plus two, again."), (2, "What is two plus three?"), (3, "请问水的化学式是什么呢"),
            (4, "中国的首都是哪座城市它位于哪里请回答"), (5, "水的化学式是未知"), (6, "yes, they said"), (7, "yesterday")]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(1, 1), (3, 2), (4, 3), (6, 4)}


def test_training_rows_are_bounded_by_rows(spark):
    docs = spark.range(20_000).select((F.col("id") % 10 * 7).alias("doc_id"), F.concat(F.lit("t "), (F.col("id") % 3).cast("string")).alias("text"))
    labels = spark.createDataFrame([(7 * i, i % 2) for i in range(10)], "doc_id long, toxic int")
    rows = labelled.training_rows(docs, labels, "toxic", 20)
    assert 0 < rows.count() <= 10
    assert labelled.training_rows(docs, labels, "toxic", 3).count() <= 3


@pytest.fixture()
def named(spark):
    """Prose that passes the rules, near copies, and columns of every inner name."""
    def prose(k):
        return " ".join(" ".join(f"word{k}x{7 * i + j}" for j in range(7)) + "." for i in range(12))
    rows = [(i, prose(i if i < 8 else 3), "en", "s", 0) for i in range(12)]
    rows += [(None, prose(99), "en", "s", 0), (4, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = ["_key", "_n", "_keep", "_bad", "_stats", "_all", "_good", "_w", "_l", "_doc", "root", "key"]
    return docs.withColumns({c: F.concat(F.lit(c + " "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in extra})


def test_stages_keep_columns_of_any_name(spark, named, tmp_path):
    inner = [c for c in named.columns if c not in ("doc_id", "text", "n_chars")]
    want = {tuple(r) for r in named.select(*inner).collect()}
    docs = named
    spark.createDataFrame([(1, "nothing that any document holds in it at all whatever it may be about")],
                          "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == named.columns
        assert {tuple(r) for r in docs.select(*inner).collect()} <= want
    left = docs.collect()
    assert len({r["_key"] for r in left}) == len(left) >= 5 and any(r["doc_id"] is None for r in left)
    packed = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path))
    assert collections.Counter(r["doc_id"] for r in packed.collect()) == collections.Counter(r["doc_id"] for r in left)


def test_scores_keep_columns_of_any_name(spark, named):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    out = rule_ensemble.score_documents(named, labels)
    assert out.columns == [*named.columns, "score", "predicted"]
    assert out.where(F.col("_stats").startswith("_stats ")).count() == named.count()


def test_near_duplicates_of_wide_ids(spark):
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(wide(spark)).collect()}
    assert set(got) == {A, B, None}
