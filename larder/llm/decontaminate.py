"""Benchmark decontamination with spaced seeds.

A seed mask looks at some of the token positions under it and ignores the
others, so two texts share a seed hash although tokens at ignored positions
were substituted. Four masks of weight seven find every overlap of thirteen
tokens with up to two substitutions anywhere. Items of seven to twelve tokens,
where the rule admits one or two, also have masks of weight six on their first
seven or ten tokens that leave out each token or each two of five token pairs;
documents are hashed under them only if the benchmark has such items.

1. Benchmark items (equal ones once) give (hash, item, position) rows for every
   mask and position, and a bit table that holds their hashes, sized by their
   number up to ``FILTER_BITS`` (beyond that it lets more through, loses nothing).
2. One pass over the documents hashes every position under every mask; the
   broadcast bit table lets through what can be a hit. Neighbouring hits form a
   segment of the document, which leaves the task with the tokens around it.
3. Segment seeds join benchmark seeds by hash. A seed of more than ``COMMON``
   item positions (an opening that many items share) would pair all its items
   with all its documents; there the windows around the seed decide instead:
   each distinct window of an item or a segment is hashed once with every
   choice of admitted substitutions left out, so two windows meet only if they
   are equal enough.
4. Each (segment, item, diagonal) is verified once, token by token: somewhere
   ``MIN_TOKENS`` neighbouring positions (or the whole of a shorter item) must
   have at least ``MIN_IDENTITY`` percent equal tokens. The best stretch around
   is reported.

Defined results: null and empty texts and items match nothing; items of fewer
than seven tokens count where all their tokens stand in order; null document
ids are reported as null; repeated rows give one result per id and item; of
equal items the smallest id is reported; empty tables give an empty result;
long texts are read whole; other columns, whatever their names, are not used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import prepare_python, saved, table

#: The positions each mask looks at.
MASKS = ("1111111", "11011111", "1100111011", "1110100111")

#: Also fixed: masks at the start of items with (from, to) tokens.
SHORT_MASKS = {
    (7, 9): tuple("".join("0" if i == gap else "1" for i in range(7)) for gap in range(7)),
    (10, 12): tuple("".join("00" if i in gaps else "11" for i in range(5)) for gaps in combinations(range(5), 2)),
    **{(n, n): ("1" * n,) for n in range(1, 7)},  # a shorter item is looked up whole
}

#: Production parameters.
MIN_TOKENS = 13
MIN_IDENTITY = 80
#: Items of fewer tokens count only where all their tokens stand in order.
WHOLE = 7
#: Tokens kept on either side of a segment's hits.
CONTEXT = 48
#: The bit table has 256 bits a seed (one in 16,000 other positions passes), at
#: least 2**24 (2 MiB) and at most 2**FILTER_BITS (32 MiB).
FILTER_BITS = 28
#: Seeds at more item positions than this meet documents by whole windows.
COMMON = 16

OFFSETS = [tuple(i for i, c in enumerate(m) if c == "1") for m in chain(MASKS, *SHORT_MASKS.values())]
#: Also fixed: letters of scripts without blanks between words (Thai to Lao,
#: Burmese, Khmer, kana, Chinese characters); each of them is a token.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(rf"[^\W{UNSPACED}]+|[{UNSPACED}]")


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-cased word tokens, and the texts' bounds."""
    split = [WORD.findall((t or "").lower()) for t in texts]
    known: dict[str, int] = {}
    code = np.fromiter((known.setdefault(w, len(known)) for w in chain.from_iterable(split)), np.int64)
    digest = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "replace")) for w in known), np.uint64, len(known))
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))])
    return digest[code] if len(code) else np.zeros(0, np.uint64), bounds


def seed_hashes(tokens: np.ndarray, mask: int) -> np.ndarray:
    """Hash under a mask at every position where it fits."""
    n = len(tokens) - OFFSETS[mask][-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, 0x9E3779B97F4A7C15 * (mask + 1) % (1 << 64), np.uint64)
    for o in OFFSETS[mask]:
        h = (h ^ tokens[o:o + n]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def masks_for(lengths) -> list[int]:
    """The masks that items of these numbers of tokens have."""
    out, first = list(range(len(MASKS))), len(MASKS)
    for (least, most), masks in SHORT_MASKS.items():
        if any(least <= n <= most for n in lengths):
            out += range(first, first + len(masks))
        first += len(masks)
    return out


def filter_bits(seeds: int) -> int:
    """Width of the bit table's addresses for a number of seeds."""
    return min(FILTER_BITS, max(24, (256 * seeds).bit_length()))


def _in_filter(table: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    """Positions of the hashes whose two bits are both set: the first ``bits``
    bits of a hash address one of them, the next ``bits`` the other."""
    a = h >> np.uint64(64 - bits)
    hit = np.flatnonzero(table[a >> np.uint64(3)] >> (a & np.uint64(7)).astype(np.uint8) & 1)
    b = (h[hit] >> np.uint64(64 - 2 * bits)) & np.uint64((1 << bits) - 1)
    return hit[(table[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8) & 1).astype(bool)]


def _signed(h: np.ndarray) -> np.ndarray:
    return np.asarray(h, np.uint64).view(np.int64)


def item_seeds(items: DataFrame) -> DataFrame:
    """(hash, item_id, pos, span, width) of items (item_id, tokens): a seed's
    number of positions and the window that decides on its item."""
    def seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, tokens in zip(batch["item_id"], batch["tokens"]):
                tokens = np.asarray(tokens, np.int64).view(np.uint64)
                for m in masks_for([len(tokens)]):
                    h = seed_hashes(tokens, m)
                    h = h if m < len(MASKS) else h[:1]
                    yield pd.DataFrame({"hash": _signed(h), "item_id": item, "pos": np.arange(len(h)),
                                        "span": OFFSETS[m][-1] + 1, "width": min(MIN_TOKENS, len(tokens))})
    return items.mapInPandas(seeds, "hash long, item_id long, pos long, span int, width int")


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, tokens): distinct token sequences of at least one token."""
    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            h, bounds = token_hashes(batch["text"].tolist())
            yield pd.DataFrame({"item_id": batch["item_id"],
                                "tokens": [_signed(h[a:b]) for a, b in zip(bounds, bounds[1:])]})
    # Ids travel as text: pandas makes doubles of longs beside a null.
    return (benchmark.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), "text")
            .mapInPandas(tokens, "item_id string, tokens array<long>")
            .filter(F.size("tokens") > 0).withColumn("item_id", F.col("item_id").cast("long"))
            .groupBy("tokens").agg(F.min("item_id").alias("item_id")).select("item_id", "tokens"))


def _filter_table(seeds: DataFrame, bits: int) -> np.ndarray:
    """The bit table as bytes: at most 2**bits / 32 words reach the driver."""
    first = F.shiftrightunsigned("hash", 64 - bits)
    second = F.shiftrightunsigned("hash", 64 - 2 * bits).bitwiseAND((1 << bits) - 1)
    words = (seeds.select(F.explode(F.array(first, second)).alias("slot"))
             .groupBy(F.shiftright("slot", 5).alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"),
                                         F.col("slot").bitwiseAND(31).cast("int"))).alias("bits"))
             .toPandas())
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return out.astype("<u4").view(np.uint8)


def segments(docs: DataFrame, table: np.ndarray, bits: int, masks: list[int]) -> DataFrame:
    """(doc_id, seg, start, tokens, pos, hash): stretches of a document around
    its possible hits under ``masks``, with the hits' positions and hashes."""
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens, bounds = token_hashes(batch["text"].tolist())
            at, hashes, width = [], [], []
            for m in masks:
                h = seed_hashes(tokens, m)
                hit = _in_filter(sent.value, bits, h)
                span = OFFSETS[m][-1] + 1
                doc = np.searchsorted(bounds, hit, "right") - 1
                hit = hit[hit + span <= bounds[doc + 1]]  # not across two texts
                at.append(hit)
                hashes.append(h[hit])
                width.append(np.full(len(hit), span))
            at, hashes, width = map(np.concatenate, (at, hashes, width))
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, hashes, width = at[order], hashes[order], width[order]
            doc = np.searchsorted(bounds, at, "right") - 1
            new = np.concatenate([[True], (np.diff(doc) > 0) | (np.diff(at) > CONTEXT)])
            first = np.flatnonzero(new)
            rows = []
            for a, b in zip(first, np.append(first[1:], len(at))):
                d = doc[a]
                lo = max(bounds[d], at[a] - CONTEXT)
                hi = min(bounds[d + 1], int((at[a:b] + width[a:b]).max()) + CONTEXT)
                some = tokens[lo:hi]
                key = batch["doc_id"].iloc[d]
                key = None if pd.isna(key) else key
                seg = xxhash.xxh64_intdigest(f"{key} {lo - bounds[d]} ".encode() + some.tobytes())
                rows.append((key, int(np.uint64(seg).astype(np.int64)), int(lo - bounds[d]), _signed(some),
                             at[a:b] - lo, _signed(hashes[a:b])))
            yield pd.DataFrame(rows, columns=["doc_id", "seg", "start", "tokens", "pos", "hash"])

    return docs.mapInPandas(find, "doc_id string, seg long, start long, tokens array<long>, pos array<long>, "
                                  "hash array<long>")


def best_overlap(a: np.ndarray, b: np.ndarray, diagonal: int) -> tuple[int, int, int] | None:
    """Best stretch of a (from, to, equal tokens) against b, where position i of
    a stands at i - diagonal of b, or None if no window of it is equal enough.
    In the stretch equal tokens weigh against unequal ones so that a stretch of
    the least identity sums to zero."""
    lo, hi = max(0, diagonal), min(len(a), diagonal + len(b))
    same = a[lo:hi] == b[lo - diagonal:hi - diagonal]
    window = min(MIN_TOKENS, len(b))
    if window < WHOLE and not (len(same) == window and same.all()):
        return None
    equal = np.concatenate([[0], np.cumsum(same)])
    if len(same) < window or 100 * int((equal[window:] - equal[:-window]).max()) < MIN_IDENTITY * window:
        return None
    total = np.concatenate([[0], np.cumsum(np.where(same, 100 - MIN_IDENTITY, -MIN_IDENTITY))])
    end = int((total - np.minimum.accumulate(total)).argmax())
    start = int(total[:end + 1].argmin())
    return lo + start, lo + end, int(same[start:end].sum())


def _gaps(width: int) -> np.ndarray:
    """Every choice of the positions that may differ in a window."""
    unequal = width * (100 - MIN_IDENTITY) // 100 if width >= WHOLE else 0
    return np.array(list(combinations(range(width), unequal)), np.int64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(28))


def window_keys(window: np.ndarray) -> np.ndarray:
    """A hash of the window for every choice of positions left out: two windows
    share one if and only if (but for collisions) they are equal enough."""
    gaps = _gaps(len(window))
    part = _mixed(window + np.arange(1, len(window) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    salt = _mixed(np.arange(len(gaps), dtype=np.uint64) + np.uint64(len(window) << 32))
    return _mixed(part.sum() - part[gaps].sum(axis=1, dtype=np.uint64) + salt)


def windows_at(seeds: DataFrame) -> DataFrame:
    """(id, at, win, window) from (id, tokens, seeds: array of (pos, span,
    widths)): the windows of those widths around the seeds, each once."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, tokens, at in zip(batch["id"], batch["tokens"], batch["seeds"]):
                tokens = np.asarray(tokens, np.int64)
                todo = {(w, i) for s in at for w in s["widths"]
                        for i in range(max(0, s["pos"] + s["span"] - w), min(s["pos"], len(tokens) - w) + 1)}
                for w, i in sorted(todo):
                    part = tokens[i:i + w]
                    rows.append((key, i, int(np.uint64(xxhash.xxh64_intdigest(part.tobytes())).astype(np.int64)), part))
            yield pd.DataFrame(rows, columns=["id", "at", "win", "window"])
    return seeds.mapInPandas(cut, "id long, at long, win long, window array<long>")


def common_seed_pairs(segs: DataFrame, hits: DataFrame, items: DataFrame, seeds: DataFrame,
                      common: DataFrame) -> DataFrame:
    """(seg, item_id, diagonal) under the common seeds (hash, span, widths):
    only of windows that are equal enough."""
    def around(sites: DataFrame, owner: str, tokens: DataFrame, widths) -> DataFrame:
        at = (sites.join(common.select("hash", F.col("span").alias("long"), "widths"), "hash")
              .groupBy(owner).agg(F.collect_set(F.struct("pos", F.col("long").alias("span"),
                                                         widths.alias("widths"))).alias("seeds")))
        cut = at.join(tokens, owner).select(F.col(owner).alias("id"), "tokens", "seeds")
        return saved(windows_at(cut), "bench-windows")

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [window_keys(np.asarray(w, np.int64).view(np.uint64)) for w in batch["window"]]
            yield pd.DataFrame({"key": _signed(np.concatenate(found)) if found else [],
                                "win": np.repeat(batch["win"].to_numpy(np.int64), [len(k) for k in found])})

    theirs = around(seeds.select("hash", "item_id", "pos", "width"), "item_id", items, F.array("width"))
    ours = around(hits.select("hash", "seg", F.col("at").alias("pos")), "seg", segs.select("seg", "tokens"),
                  F.col("widths"))
    a, b = (w.select("win", "window").dropDuplicates(["win"]).mapInPandas(keys, "key long, win long")
            for w in (ours, theirs))
    near = a.join(b.withColumnRenamed("win", "their_win"), "key").select("win", "their_win").distinct()
    return (ours.select(F.col("id").alias("seg"), "at", "win").join(near, "win")
            .join(theirs.select(F.col("id").alias("item_id"), F.col("at").alias("pos"), F.col("win").alias("their_win")),
                  "their_win")
            .select("seg", "item_id", (F.col("at") - F.col("pos")).alias("diagonal")))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, doc_start, doc_end, item_start, n_tokens, n_equal of the
    longest verified overlap of every contaminated document and item."""
    spark = docs.sparkSession
    prepare_python(spark)
    items = saved(benchmark_items(benchmark), "bench-items")
    seeds = saved(item_seeds(items), "bench-seeds")
    short = items.select(F.size("tokens").alias("n")).filter(F.col("n") < MIN_TOKENS).distinct().collect()  # a few rows
    bits = filter_bits(seeds.count())
    segs = saved(segments(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text"),
                          _filter_table(seeds, bits), bits, masks_for([r["n"] for r in short]))
                 .dropDuplicates(["seg"]), "bench-segments")
    hits = segs.select("seg", F.explode(F.arrays_zip("pos", "hash")).alias("h")).select(
        "seg", F.col("h.pos").alias("at"), F.col("h.hash").alias("hash"))
    common = saved(seeds.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.max("span").alias("span"),
                                             F.collect_set("width").alias("widths"))
                   .filter(F.col("n") > COMMON).select("hash", "span", "widths"), "bench-common")
    rare = seeds.join(common.select("hash"), "hash", "left_anti")
    pairs = (hits.join(rare.select("hash", "item_id", "pos"), "hash")
             .select("seg", "item_id", (F.col("at") - F.col("pos")).alias("diagonal")))
    if not common.isEmpty():
        pairs = pairs.unionByName(common_seed_pairs(segs, hits, items, seeds, common))
    pairs = pairs.distinct()
    both = (pairs.join(segs.select("doc_id", "seg", "start", F.col("tokens").alias("a")), "seg")
            .join(items.select("item_id", F.col("tokens").alias("b")), "item_id"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, item, start, d, a, b in zip(*(batch[c] for c in (
                    "doc_id", "item_id", "start", "diagonal", "a", "b"))):
                a, b = np.asarray(a), np.asarray(b)
                found = best_overlap(a, b, d)
                if found:
                    lo, hi, equal = found
                    rows.append((None if pd.isna(doc) else doc, item, start + lo, start + hi, lo - d, hi - lo,
                                 equal))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "doc_start", "doc_end", "item_start", "n_tokens",
                                              "n_equal"])

    schema = ("doc_id string, item_id long, doc_start long, doc_end long, item_start long, n_tokens long, "
              "n_equal long")
    found = both.select("doc_id", "item_id", "start", "diagonal", "a", "b").mapInPandas(verify, schema)
    best = F.max(F.struct("n_equal", "n_tokens", -F.col("doc_start"), "doc_start", "doc_end", "item_start"))
    return (found.groupBy("doc_id", "item_id").agg(best.alias("m"))
            .select(F.col("doc_id").cast("long").alias("doc_id"), "item_id", "m.doc_start", "m.doc_end", "m.item_start", "m.n_tokens", "m.n_equal"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: contaminated documents with the benchmark items they hold."""
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
