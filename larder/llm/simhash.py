"""SimHash near-duplicates with pivot distance tables.

1. A fingerprint per document: XXH64 of every 4-word shingle, a bit where more
   than half of the hashes have it. Equal fingerprints become one row.
2. Fingerprints meet under keys of two of six bit blocks: two fingerprints at
   four bits or fewer agree on at least two blocks, so no pair is lost.
3. Inside a key, a table holds each fingerprint's Hamming distances to
   ``PIVOTS`` fixed reference fingerprints. Distances of a pair to one pivot
   differ by no more than the pair's own distance, so a pair whose coordinates
   differ by more than the bound anywhere is discarded; the survivors are
   verified by their differing bits. Larger groups grow trees from the table
   (links of a spanning forest: one fewer than members, not all pairs), which
   keeps every component.
4. A key with more than ``TILE`` fingerprints is cut into tiles whose pairs of
   tiles are dealt to tasks: exact, and a task never holds more than two tiles.
5. Components by joins; documents get the smallest id of theirs.

Defined results: a text without words has fingerprint zero, linked like any
other; fewer than four words make one shingle; null ids pass through and never
are a component's id unless all its ids are null (then null); repeated rows
are copies of each other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import prepare_python, saved, table
from larder.llm.components import components

#: Production parameters.
SHINGLE = 4
SEED = 42
MAX_BITS = 4
PIVOTS = 16
TILE = 20_000
#: Runs up to this size are compared pair by pair.
SMALL = 8

#: Bit ranges of the six blocks (start, width).
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]


def pivots() -> np.ndarray:
    """The reference fingerprints: hashes of 0, 1, 2, ..."""
    return np.array([xxhash.xxh64_intdigest(str(i), SEED) for i in range(PIVOTS)], np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[shingle - 1:])]
    n = len(hashes)
    seen = np.zeros(64, np.int64)
    for first in range(0, n, 8192):
        some = np.array(hashes[first:first + 8192], "<u8").view(np.uint8).reshape(-1, 8)
        seen += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * seen > n, bitorder="little").view("<i8")[0])


def fingerprint_column(text):
    """Fingerprint (long) of a text column, vectorised by Arrow batches."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")
    return of(text)


def _close(a: np.ndarray, b: np.ndarray, ta: np.ndarray, tb: np.ndarray, bits: int) -> np.ndarray:
    """Which rows are within ``bits``: pivot coordinates first, then verified."""
    ok = np.flatnonzero((np.abs(ta - tb) <= bits).all(axis=1))
    ok = ok[np.bitwise_count(a[ok] ^ b[ok]) <= bits]
    out = np.zeros(len(a), bool)
    out[ok] = True
    return out


def distance_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def forest(fps: np.ndarray, tab: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph "within ``bits``" on ``fps``."""
    order = np.argsort(tab[:, 0], kind="stable")
    fps, tab = fps[order], tab[order]
    left = np.arange(len(fps))
    links = []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            first = tab[left, 0]  # ascending: a slice holds all that can be near
            a = np.searchsorted(first, tab[x, 0] - bits, "left")
            b = np.searchsorted(first, tab[x, 0] + bits, "right")
            near = left[a:b]
            hit = _close(fps[near], np.broadcast_to(fps[x], len(near)), tab[near], tab[x][None, :], bits)
            if hit.any():
                found = near[hit]
                links += [(int(fps[x]), int(fps[y])) for y in found]
                queue += found.tolist()
                left = np.concatenate([left[:a], near[~hit], left[b:]])
    return links


def linker(bits: int, tile: int | None):
    """A mapInPandas function over rows sorted by key: links (u, v), and with
    ``tile`` the rows (key, fp) of keys that hold more than that."""
    def signed(x: np.ndarray) -> np.ndarray:
        return np.asarray(x, np.uint64).view(np.int64)

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        refs = pivots()
        names = [["key"], ["key", "t", "u"]][tile is None]
        held: list[pd.DataFrame] = []  # rows of the open key
        spilling = False

        def rows(kind: int, a, b) -> pd.DataFrame:
            return pd.DataFrame({"kind": np.full(len(a), kind, np.int32), "u": a, "v": b})

        def solve(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
            """Links within the complete runs of ``frame``."""
            if len(frame) < 2:
                return
            same = (frame[names].to_numpy()[1:] == frame[names].to_numpy()[:-1]).all(axis=1)
            start = np.flatnonzero(np.concatenate([[True], ~same]))
            size = np.diff(np.append(start, len(frame)))
            fps = frame["fp"].to_numpy().astype(np.int64).view(np.uint64)
            us, vs = [], []
            for s in range(2, SMALL + 1):
                of = start[size == s]
                if len(of):
                    tabs = [distance_table(fps[of + i], refs) for i in range(s)]
                    for i, j in combinations(range(s), 2):
                        hit = _close(fps[of + i], fps[of + j], tabs[i], tabs[j], bits)
                        us.append(signed(fps[of[hit] + i]))
                        vs.append(signed(fps[of[hit] + j]))
            for at, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist()):
                some = fps[at:at + n]
                links = forest(some, distance_table(some, refs), bits)
                if links:
                    both = np.array(links, np.uint64)
                    us.append(signed(both[:, 0]))
                    vs.append(signed(both[:, 1]))
            if us and sum(map(len, us)):
                yield rows(0, np.concatenate(us), np.concatenate(vs))

        for batch in batches:
            if not len(batch):
                continue
            key = batch[names].to_numpy()
            if held and not (held[-1][names].to_numpy()[-1] == key[0]).all():
                if not spilling:
                    yield from solve(pd.concat(held))
                held, spilling = [], False
            tail = int((key == key[-1]).all(axis=1).argmax())  # the last key may go on
            if tail:
                done = pd.concat([*held, batch.iloc[:tail]]) if not spilling else None
                if spilling:
                    mine = (key[:tail] == held[-1][names].to_numpy()[-1]).all(axis=1)
                    yield rows(1, batch["key"].to_numpy()[:tail][mine], batch["fp"].to_numpy()[:tail][mine])
                    done = batch.iloc[:tail][~mine]
                yield from solve(done)
                held, spilling = [], False
            held.append(batch.iloc[tail:])
            if tile is not None and not spilling and sum(map(len, held)) > tile:
                spilling = True
                all_held = pd.concat(held)
                yield rows(1, all_held["key"].to_numpy(), all_held["fp"].to_numpy())
                held = [held[-1].iloc[-1:]]
            elif spilling:
                yield rows(1, held[-1]["key"].to_numpy(), held[-1]["fp"].to_numpy())
                held = [held[-1].iloc[-1:]]
        if held and not spilling:
            yield from solve(pd.concat(held))
    return link


def keyed(fps: DataFrame) -> DataFrame:
    """(key, fp): a row for each of the fifteen pairs of blocks."""
    def bits(start: int, width: int):
        return F.shiftrightunsigned(F.col("fp"), start).bitwiseAND(F.lit((1 << width) - 1))
    keys = [F.lit(k << 22).bitwiseOR(F.shiftleft(bits(*a), b[1])).bitwiseOR(bits(*b)).cast("long")
            for k, (a, b) in enumerate(combinations(BLOCKS, 2))]
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def near_links(fps: DataFrame, bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """Links (u, v) that keep every component of "``bits`` or fewer differing
    bits" among distinct fingerprints ``fp``."""
    prepare_python(fps.sparkSession, 10_000)
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "kind int, u long, v long"
    first = saved(keyed(fps).repartition(parts, "key").sortWithinPartitions("key")
                  .mapInPandas(linker(bits, tile), schema), "simhash-links")
    links, large = first.filter("kind = 0").select("u", "v"), first.filter("kind = 1")
    large = large.select(F.col("u").alias("key"), F.col("v").alias("fp"))
    cuts = large.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("r"))
    tiles = (large.join(cuts, "key").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("r")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("r") - 1)))
             .select("key", F.least("own", "other").alias("t"), F.greatest("own", "other").alias("u"), "fp"))
    more = (tiles.repartition(parts, "key", "t", "u").sortWithinPartitions("key", "t", "u")
            .mapInPandas(linker(bits, None), schema))
    return links.union(more.select("u", "v"))


def classes(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """``prints`` (doc_id, fp) with root (a fingerprint) and component_id. Read
    several times: pass a written table."""
    reps = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-prints")
    roots = saved(components(near_links(reps.select("fp"), bits)), "simhash-roots")
    labelled = reps.join(roots, reps["fp"] == roots["node"], "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = labelled.groupBy("root").agg(F.min("rep").alias("component_id"))
    member = labelled.join(least, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    return prints.join(member, prints["fp"] == member["_fp"]).drop("_fp")


def row_key(id_col: str = "doc_id", text: str = "text"):
    """64-bit hash of a row's id and text: names a row even without an id."""
    return F.xxhash64(F.col(id_col).cast("string"), F.md5(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, fp) of every row, written to the shared folder."""
    prepare_python(docs.sparkSession)
    return saved(docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text).alias("key"),
                             fingerprint_column(F.col(text)).alias("fp")), "simhash-docs")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id."""
    return classes(fingerprints(docs, id_col, text).drop("key")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the smallest id's (rows without an
    id come last), and one of rows that repeat both id and text."""
    first = (classes(fingerprints(docs, id_col, text)).groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first")))
    keep = first.select(F.col("first.key").alias("_keep")).distinct()
    one = Window.partitionBy("_keep").orderBy(F.lit(0))
    # The row travels as one struct, so its columns may have any names.
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), row_key(id_col, text).alias("_key"))
    return (rows.join(keep, F.col("_key") == F.col("_keep"))
            .withColumn("_n", F.row_number().over(one)).filter("_n = 1")
            .select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: fingerprint and near-duplicate class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
