"""Quality rules, fingerprints, decontamination."""

import itertools
import re

import duckdb
import numpy as np
import pandas as pd
import pytest

from larder.llm import decontaminate, quality_rules, simhash
from larder.llm.components import components
from llm_fixtures import SF001, SF01, no_docs, odd_docs  # noqa: F401


def duck(sql, **frames):
    con = duckdb.connect()
    for name, frame in frames.items():
        con.register(name, frame)
    return con.execute(sql).df()


def test_quality_rules_match_sql_on_odd_texts(spark, odd_docs):
    got = (quality_rules.apply_quality_rules(odd_docs)
           .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
           .toPandas())
    want = duck(quality_rules.SQL, documents=odd_docs.select("doc_id", "text").toPandas())[list(got.columns)]
    order = ["n_words", "word_chars", "doc_id"]
    pd.testing.assert_frame_equal(got.sort_values(order).reset_index(drop=True),
                                  want.sort_values(order).reset_index(drop=True), check_dtype=False)


def test_quality_rules_remove_lines(spark, no_docs):
    prose = " ".join(" ".join(f"word{7 * i + j}" for j in range(7)) + "." for i in range(12))
    menu = " | ".join(f"Item{i}" for i in range(20))
    rows = [(1, prose + "\nhome | news | about | contact\nWe use cookies.\nheading"),
            (2, "\n".join(menu for _ in range(3)) + "\nShort end."), (3, prose.replace(" ", "### "))]
    got = {r["doc_id"]: r for r in quality_rules.apply_quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["kept"] and got[1]["clean_text"] == prose and got[1]["n_lines_kept"] == 1
    assert not got[2]["kept"] and not got[3]["kept"]
    assert quality_rules.apply_quality_rules(no_docs).count() == 0


def test_quality_rules_plan_is_native(spark):
    plan = quality_rules.query(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan


def test_quality_rules_scan_few_texts_at_a_time(spark, scratch):
    """A batch of the scan holds hundreds of whole texts, not thousands."""
    spark.conf.unset("spark.sql.parquet.columnarReaderBatchSize")
    path = f"{scratch}/documents.parquet"
    spark.range(3000).selectExpr("id AS doc_id", "repeat('some words. ', 60) AS text").coalesce(1).write.parquet(path)
    got = quality_rules.query(spark, scratch)
    plan = got._jdf.queryExecution().executedPlan()
    assert got._jdf.collectAsList().size() == 3000  # runs this very plan
    nodes, batches = [plan], []
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if node.metrics().contains("numInputBatches"):
            batches.append(node.metrics().apply("numInputBatches").value())
    assert len(batches) == 1 and batches[0] >= 10


def brute_components(ids, fps, bits=4):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    u = np.array(fps, np.int64).view(np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(u[i] ^ u[i + 1:]) <= bits) + i + 1:
            parent[root(j)] = root(i)
    least = {}
    for i, x in enumerate(ids):
        least[root(i)] = min(least.get(root(i), x), x)
    return {x: least[root(i)] for i, x in enumerate(ids)}


def naive_fingerprint(text):
    import xxhash
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", text.encode().lower()) if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_matches_brute_force(spark):
    got = simhash.query(spark, SF01).toPandas()
    fps = [np.uint64(int(x, 16)).astype(np.int64) for x in got["fingerprint"]]
    want = brute_components(got["doc_id"].tolist(), fps)
    assert (got["component_id"] == got["doc_id"].map(want)).all()
    texts = spark.read.parquet(f"{SF01}/documents.parquet").toPandas().set_index("doc_id")["text"]
    for doc, fp in zip(got["doc_id"][:100], got["fingerprint"]):
        assert int(fp, 16) == naive_fingerprint(texts[doc])


@pytest.mark.parametrize("tile", [20_000, 50])
def test_links_keep_components(spark, tile):
    rng = np.random.default_rng(0)
    seen = set(rng.integers(0, 2 ** 63, 20, dtype=np.uint64).tolist())
    for start in list(seen)[:4]:
        at = start
        for _ in range(120):
            for k in rng.integers(0, 64, rng.integers(1, 7)):
                at ^= 1 << int(k)
            seen.add(at)
            at = start if rng.random() < 0.6 else at
    fps = np.array(sorted(seen), np.uint64).view(np.int64).tolist()
    links = simhash.near_links(spark.createDataFrame([(x,) for x in fps], "fp long"), 4, tile)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    want = brute_components(list(range(len(fps))), fps)
    pairs = {(roots.get(x, x), want[i]) for i, x in enumerate(fps)}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_simhash_odd_rows(spark, odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).toPandas()
    assert len(got) == odd_docs.count()
    zero = got[got["fingerprint"] == "0" * 16]
    assert len(zero) == 6 and (zero["component_id"] == 0).all()
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == got["component_id"].nunique(dropna=False)
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.drop_near_duplicates(no_docs).count() == 0


def test_decontamination_finds_planted_overlaps(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(5000)]
    words = lambda n: rng.choice(vocabulary, n).tolist()
    items = [(i, " ".join(words(n))) for i, n in enumerate([30, 13, 9, 50, 6])] + [(9, None), (10, ""), (11, "")]
    items.append((12, items[0][1].upper()))  # equal to item 0
    docs, want = [], set()
    for k in range(60):
        body = words(200)
        item = k % 4
        part = items[item][1].split()
        if k % 3 == 0 and len(part) >= 13:  # two substitutions in every thirteen tokens
            for a in range(0, len(part), 13):
                for j in rng.choice(13, 2, replace=False):
                    if a + j < len(part):
                        part[a + j] = "changed"
        if k % 5:
            body[70:70] = part
            want.add((k, item))
        docs.append((k, ", ".join(body)))
    docs += [(100, None), (101, ""), (102, items[4][1]), (None, items[0][1])]
    got = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string")).toPandas()
    found = {(int(d), int(i)) for d, i in zip(got["doc_id"], got["item_id"]) if d == d and d is not None}
    want.add((102, 4))  # a whole item of six tokens
    assert found == want
    assert got["doc_id"].isna().sum() == 1


def test_decontamination_finds_every_admitted_substitution_in_short_items(spark):
    items = [(n, " ".join(f"i{n}x{j}" for j in range(n))) for n in range(7, 13)]
    docs, want = [], set()
    for n, text in items:
        for gaps in itertools.combinations(range(n), 1 if n < 10 else 2):
            part = ["changed" if j in gaps else w for j, w in enumerate(text.split())]
            want.add((len(docs), n))
            docs.append((len(docs), " ".join(part if len(docs) % 2 else ["a", "b", *part, "c"])))
    got = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string")).toPandas()
    assert set(zip(got["doc_id"], got["item_id"])) == want


def test_decontamination_matches_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").toPandas()
    bench = spark.read.parquet(f"{SF01}/benchmark.parquet").toPandas()
    norm = lambda x: re.findall(r"\w+", x.lower())
    grams = {}
    for i, x in zip(bench["item_id"], bench["text"]):
        w = norm(x)
        k = min(13, len(w))
        for j in range(len(w) - k + 1):
            grams.setdefault(tuple(w[j:j + k]), set()).add(i)
    want = set()
    for d, x in zip(docs["doc_id"], docs["text"]):
        w = norm(x)
        for k in {len(g) for g in grams}:
            for j in range(len(w) - k + 1):
                want |= {(d, i) for i in grams.get(tuple(w[j:j + k]), ())}
    got = decontaminate.query(spark, SF01).toPandas()
    assert want <= set(zip(got["doc_id"], got["item_id"]))
    assert (got["n_equal"] * 100 >= 80 * got["n_tokens"]).all()


def test_decontamination_is_the_80_percent_rule_both_ways(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").toPandas()
    bench = spark.read.parquet(f"{SF01}/benchmark.parquet").toPandas()
    code: dict[str, int] = {}
    split = lambda x: [code.setdefault(w, len(code)) for w in decontaminate.WORD.findall((x or "").lower())]
    parts = [split(x) for x in docs["text"]]
    apart = [-1] * 13  # no window reaches into the next document
    at = np.array([t for x in parts for t in x + apart])
    owner = np.repeat(docs["doc_id"].to_numpy(), [len(x) + 13 for x in parts])
    items, want = {}, set()
    for i, x in sorted(zip(bench["item_id"], bench["text"])):
        items.setdefault(tuple(split(x)), i)
    for tokens, i in items.items():
        k = min(13, len(tokens))
        for q in range(len(tokens) - k + 1):
            n = len(at) - k + 1
            equal = sum((at[t:t + n] == tokens[q + t]).astype(np.int32) for t in range(k))
            want |= {(d, i) for d in owner[:n][equal * 100 >= (80 if k >= 7 else 100) * k]} if k else set()
    got = decontaminate.query(spark, SF01).toPandas()
    assert set(zip(got["doc_id"], got["item_id"])) == want and len(want) > 0


def test_window_keys_are_shared_by_equal_enough_windows_only():
    rng = np.random.default_rng(5)
    for width in (*range(1, 14),):
        admitted = width * 20 // 100 if width >= 7 else 0
        for k in range(min(width, 4) + 1):
            w = rng.integers(0, 1 << 62, width).astype(np.uint64)
            v = w.copy()
            v[rng.choice(width, k, replace=False)] += np.uint64(1)
            shared = np.intersect1d(decontaminate.window_keys(w), decontaminate.window_keys(v))
            assert (len(shared) > 0) == (k <= admitted)


def test_decontamination_with_common_openings_verifies_few_pairs(spark, monkeypatch):
    rng = np.random.default_rng(9)
    opening = "which of the following statements is true of the old"
    vocabulary = [f"w{i}" for i in range(20000)]
    words = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(i, f"{opening} {words(20)}") for i in range(400)]
    items += [(400 + i, f"{opening.split(' ', 3)[3]} {words(n)}") for i, n in enumerate([2, 3, 5] * 30)]
    docs = [(i, f"{opening} {words(30)}") for i in range(400)]
    for i in range(0, 490, 7):  # copies, some with two tokens changed
        part = items[i][1].split()
        if i % 2 and len(part) >= 13:
            part[2] = part[11] = "changed"
        docs.append((1000 + i, f"{words(9)} {' '.join(part)} {words(9)}"))
    verified = spark.sparkContext.accumulator(0)
    real = decontaminate.best_overlap

    def counted(a, b, diagonal):
        verified.add(1)
        return real(a, b, diagonal)

    def pairs():
        got = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"),
                                     spark.createDataFrame(items, "item_id long, text string")).collect()
        return {tuple(r) for r in got}

    monkeypatch.setattr(decontaminate, "COMMON", 1 << 40)  # every seed pairs all its items and documents
    every = pairs()
    monkeypatch.setattr(decontaminate, "COMMON", 16)
    monkeypatch.setattr(decontaminate, "best_overlap", counted)
    assert pairs() == every and {(1000 + i, i) for i in range(0, 490, 7)} <= {r[:2] for r in every}
    assert 70 <= verified.value < 2000  # of 480 x 470 that share the opening


def test_decontamination_of_nothing(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.overlaps(odd_docs, none).count() == 0
    assert decontaminate.overlaps(no_docs, spark.createDataFrame([(1, "a b c d e f g h")], none.schema)).count() == 0
