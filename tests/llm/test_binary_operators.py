"""Token files, archives, packing, sharding: exact round trips."""

import base64
import hashlib
import zlib

import numpy as np
import pytest

from larder.llm import packing, pfor, sharding, warc
from larder.llm.common import saved, shared_path
from larder.llm.tokens import WordEncoder, tokenizer_path
from llm_fixtures import SF001, SF01, no_docs, odd_docs  # noqa: F401


def reference_ids(texts, end):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    return [np.array(t.encode(x or "", add_special_tokens=False).ids + [end], "<u4") for x in texts]


def test_word_encoder_equals_the_tokenizer(spark):
    texts = spark.read.parquet(f"{SF001}/documents.parquet").toPandas()["text"].tolist()
    texts += ["", None, "a <|endoftext|> b<|endoftext|>c İstanbul ΟΔΟΣ é é x ́y \x1ca\x1fb  q\t\r\n don't we'll 12,3",
              "Ａ ﬁ ǅ ×÷ 漢字カナ 한글", "'s 'T don'T I'LL"]
    ids, lengths = WordEncoder(tokenizer_path()).encode(texts, 2)
    ends = np.cumsum(lengths)
    for want, end, n in zip(reference_ids(texts, 2), ends, lengths):
        assert ids[end - n:end].tolist() == want.tolist()


@pytest.mark.parametrize("percentile", [1, 50, 90, 100])
@pytest.mark.parametrize("top", [1, 10, 50_000, 2 ** 32 - 1])
def test_blocks_round_trip(top, percentile):
    rng = np.random.default_rng(top)
    ids = rng.integers(0, top, size=(200, pfor.BLOCK), dtype=np.uint64).astype(np.uint32)
    ids[rng.random(ids.shape) < 0.03] = 2 ** 32 - 1
    ids[5] = 7
    raw, size = pfor.encode_blocks(ids, percentile)
    assert (pfor.decode_blocks(raw, np.cumsum(size) - size) == ids).all()


def test_token_files_round_trip(spark, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text").toPandas()
    folder = shared_path(spark, "t")
    got = pfor.read_files(spark, pfor.write_files(odd_docs, folder, tokenizer_path()), with_ids=True).toPandas()
    got = got.sort_values("start").reset_index(drop=True)
    docs["order"] = docs["doc_id"].fillna(-1)
    docs = docs.sort_values(["order", "text"], na_position="first").reset_index(drop=True)
    start = 0
    for k, ids in enumerate(reference_ids(docs["text"], 2)):
        row = got.iloc[k]
        assert row["start"] == start and row["n_tokens"] == len(ids)
        assert row["ids_crc32"] == zlib.crc32(ids.tobytes()) and list(row["ids"]) == ids.tolist()
        start += len(ids)
    assert len(got) == len(docs)
    assert pfor.read_files(spark, pfor.write_files(no_docs, shared_path(spark, "t"), tokenizer_path())).count() == 0


def test_rows_of_one_id_are_spread_over_files(spark):
    texts = [f"{k % 7} of many" for k in range(400)]
    docs = spark.createDataFrame([(None if k % 2 else 2 ** 60 + 1, t) for k, t in enumerate(texts)],
                                 "doc_id long, text string")
    files = pfor.write_files(docs, shared_path(spark, "t"), tokenizer_path())
    assert len(files) > 3 and max(f["n_docs"] for f in files) < 200
    got = pfor.read_files(spark, files).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None] * 200 + [2 ** 60 + 1] * 200
    crc = sorted(zlib.crc32(ids.tobytes()) for ids in reference_ids(texts, 2))
    assert sorted(r["ids_crc32"] for r in got) == crc
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))


def test_one_document_by_the_index(spark, tmp_path):
    ids = [np.arange(n, dtype=np.uint32) * 3 for n in (1, 127, 128, 129, 5000, 1)]
    with open(tmp_path / "f", "wb") as f:
        out = pfor.FileWriter(f)
        out.add([5, 6, None, 8, 9, 10], np.concatenate(ids), np.array([len(x) for x in ids]))
        out.close()
    with open(tmp_path / "f", "rb") as f:
        reader = pfor.FileReader(f)
        for k, want in enumerate(ids):
            assert reader.document(k).tolist() == want.tolist()
        assert reader.nulls.tolist() == [False, False, True, False, False, False]


def fake_record():
    return warc.record(999, "http://fake", b"fake", None).decode()


@pytest.mark.parametrize("size", [64, 333, 1 << 20])
def test_archives_reject_magic_in_payloads(spark, size):
    fake = fake_record()
    rows = [(1, "http://a b", "x" * 50 + fake + fake[:60]), (2, None, None), (3, "u", ""), (None, "u", ""),
            (5, "u", "WARC/1.1\r\n\r\n"), (6, "u", ("y" * 300 + fake) * 5), (7, "u", ("y" * 300 + fake) * 5),
            (None, "q", "zzz"), (8, "u", "WARC/1.1\r\nContent-Length: 1\r\n\r\n"), (9, "u", fake)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    files = warc.write_archives(pages, shared_path(spark, "w"))
    got = warc.resolved(saved(warc.read_archives(spark, files, size), "w")).collect()
    assert len(got) == len(rows)
    newest = {}
    for page, _, html in rows:
        newest[html or ""] = max(newest.get(html or "", -1), -1 if page is None else page)
    by_page = {r["page_id"]: r for r in got if r["page_id"] is not None}
    for page, _, html in rows:
        if page is None:
            continue
        payload, r = (html or "").encode(), by_page[page]
        assert r["payload_bytes"] == len(payload)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first = newest[html or ""]
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first == page else ("revisit", first))


def test_archives_of_pages(spark):
    got = warc.query(spark, SF01).toPandas().set_index("page_id")
    pages = spark.read.parquet(f"{SF01}/pages.parquet").toPandas()
    assert len(got) == len(pages)
    for page, html in zip(pages["page_id"], pages["html"]):
        assert got.loc[page, "payload_digest"] == base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
    none = spark.createDataFrame([], "page_id long, url string, html string")
    files = warc.write_archives(none, shared_path(spark, "w"))
    assert warc.resolved(saved(warc.read_archives(spark, files), "w")).count() == 0


def check_packing(got, texts, capacity=4096):
    by_sequence = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    for _, s in by_sequence:
        assert s["offset"].tolist() == [0, *np.cumsum(s["length"]).tolist()[:-1]] and s["length"].sum() <= capacity
    assert got["length"].sum() == sum(map(len, texts))


def test_packing_places_every_piece(spark, odd_docs, no_docs):
    got = packing.pack_documents(odd_docs, tokenizer_path()).toPandas()
    ids = reference_ids(odd_docs.toPandas()["text"], 1)
    check_packing(got, ids)
    assert sorted(got[got["piece"] == 0]["ids_crc32"]) == sorted(zlib.crc32(x[:4096].tobytes()) for x in ids)
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for _, r in got.iterrows())
    assert packing.pack_documents(no_docs, tokenizer_path()).count() == 0


def test_packing_is_near_the_bound(spark):
    got = packing.query(spark, SF01).toPandas()
    check_packing(got, reference_ids(spark.read.parquet(f"{SF01}/documents.parquet").toPandas()["text"], 1))
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 4096) * 1.01 + 1
    assert not got.duplicated(["doc_id", "piece"]).any()


def test_plan_covers_every_rank_once():
    rng = np.random.default_rng(1)
    counts = {int(n): int(c) for n, c in zip(rng.choice(np.arange(1, 4097), 300, False), rng.integers(1, 5000, 300))}
    counts[4096] = 100_000
    runs = packing.plan_runs(counts)
    seen = {}
    for length, rank, n, _, _ in runs:
        seen.setdefault(length, []).append((rank, n))
    for length, parts in seen.items():
        at = 0
        for rank, n in sorted(parts):
            assert rank == at
            at += n
        assert at == counts[length]
    used = max(s + n for _, _, n, s, _ in runs)
    best_fit_only = max(s + n for _, _, n, s, _ in packing.plan_runs(counts, large=0))
    assert used <= 1.01 * best_fit_only


def check_shards(got, rows, shards=16):
    sizes = got.groupby("shard").size()
    assert len(got) == rows and sizes.max() - (sizes.min() if len(sizes) == shards else 0) <= 1
    for _, s in got.groupby("shard"):
        assert sorted(s["slot"]) == list(range(len(s)))


def test_sharding_keeps_copies_together(spark, no_docs, odd_docs):
    got = sharding.query(spark, SF01).toPandas()
    texts = spark.read.parquet(f"{SF01}/documents.parquet").toPandas().set_index("doc_id")["text"]
    check_shards(got, len(texts))
    assert (got["law"] == "rows").all() and got["grown_shard"].isna().all()
    for doc, size, crc in zip(got["doc_id"], got["size"], got["text_crc32"]):
        assert size == len(texts[doc].encode()) + 1 and crc == zlib.crc32(texts[doc].encode())
    assert (got.groupby(got["doc_id"].map(texts))["shard"].nunique() == 1).all()
    check_shards(sharding.shard_documents(odd_docs).toPandas(), odd_docs.count())
    assert sharding.shard_documents(no_docs).count() == 0


def test_sharding_cuts_only_what_must_be_cut(spark):
    rows = [(i, "hot") for i in range(400)] + [(i, f"pair {i // 2}") for i in range(400, 800)]
    rows += [(i, f"alone {i}") for i in range(800, 1200)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    check_shards(got, 1200)
    pairs = got[got["doc_id"].between(400, 799)]
    assert (pairs.groupby("text_crc32")["shard"].nunique() > 1).sum() <= 8
    assert got[got["doc_id"] < 400]["shard"].nunique() <= 8  # six would hold them


def test_sharding_plan_is_native(spark):
    plan = sharding.query(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
