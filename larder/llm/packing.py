"""Best-fit packing of token pieces into sequences by linear grouping.

The multiset of piece lengths (at most ``capacity`` distinct values, whatever
the corpus holds) is all that the plan needs:

1. lengths above ``capacity / LARGE`` are sorted and cut into ``GROUPS`` groups
   of equal cardinality; every length counts as its group's largest;
2. configurations of the few rounded sizes are optimised by column generation
   (a linear program, priced by a knapsack) and used a whole number of times;
3. actual lengths are substituted for the rounded ones, which leaves room;
4. everything else, longest first, goes where it fits best.

A plan is a table of runs ("pieces of this length with ranks from..to go to
consecutive sequences, at this offset"), bounded by the capacity alone. Spark
ranks the pieces within their length and joins the plan.

Defined results: a null or empty text is one piece that holds the end id; rows
that repeat an id are packed one by one; null ids pass through; only texts
above the capacity are cut; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import hash_bucket, prepare_python, saved, table, with_rank
from larder.llm.tokens import MAX_WORDS, encoder, tokenizer_path

#: Production parameters.
CAPACITY = 4096
END_ID = 1
GROUPS = 64
LARGE = 3
#: Texts encoded at a time and words kept by an encoder when nothing else shares
#: the executor (the pipeline takes the smaller defaults).
ROWS = 1000
WORDS = 700_000
#: Rows of one length that a rank bucket holds on average.
RANK_ROWS = 200_000


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY,
               id_col: str = "doc_id", text: str = "text", rows: int = 250, words: int = MAX_WORDS) -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length, ids_crc32
    and ids (little-endian unsigned 32-bit integers). ``rows`` texts are encoded
    at a time, with ``words`` words kept by an encoder."""
    prepare_python(docs.sparkSession, rows)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer, words)
        for batch in batches:
            ids, lengths = enc.encode(batch["text"].tolist(), end_id)
            ends = np.cumsum(lengths)
            found = []
            for doc, end, n in zip(batch["id"].tolist(), ends.tolist(), lengths.tolist()):
                first = end - n
                for piece, at in enumerate(range(0, n, capacity)):
                    raw = ids[first + at:min(first + at + capacity, end)].astype("<u4").tobytes()
                    found.append((doc, piece, at, len(raw) // 4, zlib.crc32(raw), raw))
            yield pd.DataFrame(found, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    # Ids travel as text: pandas makes doubles of longs beside a null.
    pieces = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text).alias("text")).mapInPandas(
        cut, "doc_id string, piece int, start long, length long, ids_crc32 long, ids binary")
    return pieces.withColumn("doc_id", F.col("doc_id").cast("long"))


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], float]]:
    """Configurations (a count for each size) and how often the linear program
    uses each, so that every size is used at least ``demand`` times."""
    k, size = len(sizes), np.array(sizes)
    basis = np.diag(capacity // size).astype(float)
    need = np.array(demand, float)
    used = need / np.diag(basis)
    for _ in range(20 * k):
        price = np.linalg.solve(basis.T, np.ones(k))
        best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(int(size.min()), capacity + 1):
            worth = np.where(size <= c, best[np.maximum(c - size, 0)] + price, -1.0)
            i = int(worth.argmax())
            if worth[i] > best[c - 1] + 1e-12:
                best[c], last[c] = worth[i], i
            else:
                best[c] = best[c - 1]
        if best[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(k), capacity
        while c > 0:
            if last[c] < 0:
                c -= 1
            else:
                column[last[c]] += 1
                c -= size[last[c]]
        step = np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
        used = np.linalg.solve(basis, need)
    return [(basis[:, i].astype(int).tolist(), max(0.0, float(used[i]))) for i in range(k)]


def plan_runs(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS,
              large: int = LARGE) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first sequence, offset): the pieces of
    a length with ranks from the first on, one per sequence."""
    left = {n: [0, c] for n, c in counts.items() if c}  # next rank, pieces left
    open_runs: dict[int, list] = {}  # room -> runs [sequences, [(length, rank)]]
    rooms: list[int] = []
    done: list[tuple[int, list]] = []

    def put(n: int, parts: list, room: int) -> None:
        if n == 0:
            return
        if room == 0:
            done.append((n, parts))
            return
        if room not in open_runs:
            open_runs[room] = []
            insort(rooms, room)
        open_runs[room].append((n, parts))

    # Linear grouping of the large lengths.
    big = sorted((n for n in left if n * large > capacity), reverse=True)
    total = sum(left[n][1] for n in big)
    each = max(1, -(-total // groups))
    grouped, pool = [], []
    for n in big:
        rank, c = left[n]
        while c:
            if not grouped or grouped[-1][1] == each:
                grouped.append([n, 0])
                pool.append([])
            take = min(c, each - grouped[-1][1])
            pool[-1].append([n, rank, take])
            grouped[-1][1] += take
            rank, c = rank + take, c - take
    sizes: list[int] = []
    demand: list[int] = []
    stock: list[list] = []
    for (n, c), segments in zip(grouped, pool):
        if sizes and sizes[-1] == n:  # groups of one length are one size
            demand[-1] += c
            stock[-1] += segments
        else:
            sizes.append(n)
            demand.append(c)
            stock.append(segments)
    if sizes:
        for config, times in configurations(sizes, demand, capacity):
            slots = [g for g, a in enumerate(config) for _ in range(a)]
            m = int(times + 1e-6)
            m = min([m, *(demand[g] // config[g] for g in set(slots))]) if slots else 0
            if m == 0:
                continue
            for g in set(slots):
                demand[g] -= m * config[g]
            taken = []  # for each slot its segments, m pieces in all
            for g in slots:
                mine, n_left = [], m
                while n_left:
                    seg = stock[g][0]
                    take = min(n_left, seg[2])
                    mine.append([seg[0], seg[1], take])
                    seg[1], seg[2], n_left = seg[1] + take, seg[2] - take, n_left - take
                    if seg[2] == 0:
                        stock[g].pop(0)
                taken.append(mine)
            while taken and taken[0]:  # cut where any slot's length changes
                n = min(s[0][2] for s in taken)
                parts = [(s[0][0], s[0][1]) for s in taken]
                put(n, parts, capacity - sum(p[0] for p in parts))
                for s in taken:
                    s[0][1], s[0][2] = s[0][1] + n, s[0][2] - n
                    if s[0][2] == 0:
                        s.pop(0)
    rest: dict[int, list] = {}
    for segments in stock:
        for n, rank, c in segments:
            rest.setdefault(n, []).append([rank, c])
    for n in left:
        if n * large <= capacity:
            rest[n] = [left[n]]
    # Best fit, longest first.
    for n in sorted(rest, reverse=True):
        for rank, c in rest[n]:
            while c:
                i = bisect_left(rooms, n)
                if i == len(rooms):
                    fit = capacity // n
                    m = max(1, c // fit)
                    put(m, [], capacity)
                    continue
                room = rooms[i]
                m, parts = open_runs[room].pop()
                if not open_runs[room]:
                    del open_runs[room]
                    rooms.pop(i)
                if m > c:
                    put(m - c, [(a, r + c) for a, r in parts], room)
                    m = c
                put(m, [*parts, (n, rank)], room - n)
                rank, c = rank + m, c - m
    runs, sequence = [], 0
    for m, parts in [*done, *(r for room in rooms for r in open_runs[room])]:
        at = 0
        for n, rank in parts:
            runs.append((n, rank, m, sequence, at))
            at += n
        sequence += m
    return runs


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with doc_id, piece, length, ids_crc32) with sequence_id and
    offset. The pieces are read twice: pass a written table."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    runs = plan_runs(counts, capacity)
    plan = spark.createDataFrame(
        pd.DataFrame(runs, columns=["length", "_from", "_n", "_seq", "offset"], dtype="int64"),
        "length long, _from long, _n long, _seq long, offset long")
    buckets = max(1, min(4096, max(counts.values(), default=0) // RANK_ROWS))
    ranked = with_rank(pieces, ["length"], hash_bucket(["doc_id", "piece"], buckets),
                       [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "_rank")
    fits = ((ranked["length"] == plan["length"]) & (ranked["_rank"] >= plan["_from"])
            & (ranked["_rank"] < plan["_from"] + plan["_n"]))
    # The plan's rows are bounded by the capacity, not by the corpus.
    return (ranked.join(F.broadcast(plan), fits).drop(plan["length"])
            .withColumn("sequence_id", F.col("_seq") + F.col("_rank") - F.col("_from"))
            .select(*pieces.columns, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID,
                   capacity: int = CAPACITY, rows: int = 250, words: int = MAX_WORDS) -> DataFrame:
    """Pieces of ``docs`` with their ids and places; the pieces are written to
    the shared folder once, so texts are encoded a single time."""
    return assign(saved(cut_pieces(docs, tokenizer, end_id, capacity, rows=rows, words=words), "pieces"), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: place of every piece of every document."""
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), rows=ROWS, words=WORDS).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
