"""Balanced label propagation: documents to shards (native functions only).

Documents with equal texts are linked. The documents of one group in one shard
are interchangeable, so the propagation runs on cells (group, shard, number of
documents): a group of any size has at most ``shards`` rows. Each round joins
every cell with its group's largest cell whose shard has room, and moves it
there; where more documents ask for a shard than its quota admits, the largest
gains go first and the last cell is split. Rounds may fill a shard a little
above its share (``ROOM``); when nothing moves any more, whole cells leave the
overfull shards, small groups first, so only groups at the very edge (or
larger than a shard) are cut. Documents without a copy fill the rest exactly.

Law ``rows``: shard sizes differ by at most one document.

Defined results: a null text counts as empty (size 1); null ids pass through;
rows that repeat an id are documents of their own; an empty table gives an
empty result; input columns other than id and text are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import hash_bucket, saved, table, with_rank

#: Production parameters.
SHARDS = 16
ROOM = 0.05
ROUNDS = 64
#: Rows that a rank bucket holds on average.
BUCKET_ROWS = 50_000


def _loads(cells: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _by_shard(shard: Column, values: list[int]) -> Column:
    """``values[shard]`` for a list as long as there are shards."""
    return F.get(F.array(*[F.lit(v).cast("long") for v in values]), shard)


def _size_class(n: Column) -> Column:
    return F.floor(F.log2(n)).cast("int")


def _admit(requests: DataFrame, keys: list[str], quota: Column, first: Column) -> DataFrame:
    """``requests`` (g, n, ...) with ``go``: how many of the cell's documents
    move, in the order of ``first`` (a small integer), within the key's quota."""
    ranked = with_rank(requests, keys, first * 64 + hash_bucket(["g"], 64), [F.col("g"), F.col("shard")],
                       "_before", F.col("n"))
    go = F.greatest(F.lit(0), F.least(F.col("n"), quota - F.col("_before")))
    return ranked.withColumn("go", go).drop("_before").filter("go > 0")


def _moved(cells: DataFrame, moves: DataFrame) -> DataFrame:
    """Cells after ``moves`` (g, shard, to, go)."""
    out = moves.select("g", "shard", (-F.col("go")).alias("n"))
    into = moves.select("g", F.col("to").alias("shard"), F.col("go").alias("n"))
    return (cells.select("g", "shard", "n").union(out).union(into)
            .groupBy("g", "shard").agg(F.sum("n").alias("n")).filter("n > 0"))


def propagate(cells: DataFrame, shares: list[int]) -> DataFrame:
    """Rounds of label propagation; ``shares``: documents each shard holds in
    the end. The returned cells never exceed the shares."""
    shards = len(shares)
    tie = F.xxhash64("g", "shard")
    load = _loads(cells, shards)
    for _ in range(ROUNDS):
        quota = [int(c * (1 + ROOM)) + 1 - n for c, n in zip(shares, load)]
        open_cells = cells.filter(_by_shard(F.col("shard"), quota) > 0)
        top = open_cells.groupBy("g").agg(F.max(F.struct("n", tie.alias("tie"), "shard")).alias("top"))
        # A cell in a shard without room also moves to an equal one.
        shut = _by_shard(F.col("shard"), quota) <= 0
        asks = (cells.join(top, "g").filter(
            (F.col("top") > F.struct("n", tie.alias("tie"), "shard")) | (shut & (F.col("top.n") >= F.col("n"))))
                .select("g", "shard", "n", F.col("top.shard").alias("to"), F.col("top.n").alias("_gain")))
        # Moving next to many copies first: 63 classes of the target's size.
        moves = saved(_admit(asks, ["to"], _by_shard(F.col("to"), quota), 63 - _size_class(F.col("_gain"))),
                      "shard-moves")
        if moves.isEmpty():
            break
        cells = saved(_moved(cells, moves), "shard-cells")
        load = _loads(cells, shards)
    while any(n > c for n, c in zip(load, shares)):
        # Each overfull shard sends its excess to one shard with room.
        room = sorted(((c - n, s) for s, (n, c) in enumerate(zip(load, shares)) if n < c), reverse=True)
        full = sorted(((n - c, s) for s, (n, c) in enumerate(zip(load, shares)) if n > c), reverse=True)
        to, quota = [0] * shards, [0] * shards
        for (excess, s), (free, t) in zip(full, room):
            to[s], quota[s] = t, min(excess, free)
        asks = (cells.filter(_by_shard(F.col("shard"), quota) > 0)
                .withColumn("to", _by_shard(F.col("shard"), to).cast("int")))
        moves = saved(_admit(asks, ["shard"], _by_shard(F.col("shard"), quota), _size_class(F.col("n"))),
                      "shard-moves")
        cells = saved(_moved(cells, moves), "shard-cells")
        load = _loads(cells, shards)
    return cells


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null: the
    law does not fix it)."""
    t = F.coalesce(F.col(text), F.lit(""))
    nodes = saved(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(t) + 1).cast("long").alias("size"),
        F.crc32(F.encode(t, "UTF-8")).alias("text_crc32"), F.md5(F.encode(t, "UTF-8")).alias("g"))
        .withColumn("start", F.pmod(F.xxhash64("doc_id", "g"), F.lit(shards)).cast("int")), "shard-nodes")
    total = nodes.count()
    shares = [total // shards + (s < total % shards) for s in range(shards)]
    buckets = max(256, min(65_536, total // BUCKET_ROWS))
    seen = nodes.groupBy("g", F.col("start").alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    # Written, so that joins on g have plain scans on both sides: AQE can then
    # split the partition of a huge group.
    groups = saved(seen.groupBy("g").agg(F.sum("n").alias("_m")), "shard-groups")
    linked = groups.filter("_m > 1").select("g")
    cells = propagate(saved(seen.join(linked, "g").select("g", "shard", "n"), "shard-cells"), shares)

    # Documents of linked groups: cell by cell, by rank where a group is cut.
    by_group = Window.partitionBy("g").orderBy("shard")
    spans = saved(cells.withColumns({
        "_from": F.sum("n").over(by_group) - F.col("n"),
        "_cells": F.count(F.lit(1)).over(Window.partitionBy("g"))}), "shard-spans")
    own = [F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    whole = nodes.join(spans.filter("_cells = 1").select("g", "shard"), "g")
    cut = spans.filter("_cells > 1")
    cut_nodes = nodes.join(cut.select("g"), "g", "left_semi")
    ranked = with_rank(cut_nodes, ["g"], hash_bucket(["doc_id"], buckets), own, "_rank")
    parts = (ranked.join(cut.withColumnRenamed("g", "_g"), (F.col("g") == F.col("_g"))
                         & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_from") + F.col("n"))))
    columns = ["doc_id", "size", "text_crc32", "shard"]
    placed = whole.select(*columns).union(parts.select(*columns))
    slotted = with_rank(placed, ["shard"], hash_bucket(["doc_id"], buckets), own, "slot")

    # Documents without a copy fill what is left, in the order of their ranks.
    load = _loads(cells, shards)
    rest = [c - n for c, n in zip(shares, load)]
    begin = [sum(rest[:s]) for s in range(shards)]
    alone = nodes.join(groups.filter("_m = 1").select("g"), "g", "left_semi").withColumn("_all", F.lit(0))
    filled = with_rank(alone, ["_all"], hash_bucket(["doc_id", "g"], buckets), own, "_rank")
    shard = F.lit(0)
    for s in range(1, shards):
        shard = shard + (F.col("_rank") >= begin[s]).cast("int")
    filled = filled.withColumn("shard", shard).withColumn(
        "slot", F.col("_rank") - _by_shard(F.col("shard"), begin) + _by_shard(F.col("shard"), load))
    both = slotted.select(*columns, "slot").union(filled.select(*columns, "slot"))
    return both.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: shard and slot of every document."""
    return shard_documents(table(spark, sf_dir, "documents"))
