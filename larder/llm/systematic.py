"""Mixing sources to target weights by systematic sampling.

1. Sources are ranked by code point and weighted by their rank; a water level
   ``L`` with sum(min(cap, L * weight)) = budget gives the targets. Each round is
   one aggregate over the table of sources: a source whose cap lies at or below
   the level keeps its cap, the rest share what is left by weight, and the level
   rises until no further source reaches its cap.
2. Every document of a source expects target / source size copies, a whole
   number of 10**-9 parts. Exact prefix sums of these parts run over the source's
   documents in the order of their sizes (then hashes), a pseudo-random offset
   per source is added, and a document is emitted once for each whole number
   that its own interval crosses. Neighbours in that order have like sizes, so
   the words taken differ from the target by about one document.

Prefix sums never gather a source in one task: (source, size) totals come
first, then ranks inside a size by buckets of a hash.

Defined results: a null text has size 0; a null source is a source of its own,
the last one; null ids pass through; rows that repeat an id are documents of
their own (equal ones are interchangeable); sources without a word have target
0; a document without words takes 0; an empty table gives an empty result;
whole texts are counted, of any length; extra input columns, whatever their
names, are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import saved, table, with_rank, words_of

#: Production parameters: weights by rank of the source, share of all sizes that
#: the mix takes, cap as a multiple of a source's size.
WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
CAP = 2
SEED = "mix"
#: Expected copies are whole numbers of these parts.
PARTS = 10 ** 9
#: Rows that a rank bucket holds on average.
BUCKET_ROWS = 50_000


def _big(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(38,0)")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """``sizes`` (source, source_size) with ``weight`` by the source's rank in code
    point order, nulls last; ranges of sources are numbered apart."""
    placed = saved(sizes.repartitionByRange(F.asc_nulls_last("source")).sortWithinPartitions(F.asc_nulls_last("source"))
                   .withColumn("_at", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = (placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), F.pmod(rank, F.lit(len(WEIGHTS))).cast("int"))
    return (placed.withColumn("_part", part).join(offsets, "_part")
            .select("source", "source_size", weight.cast("long").alias("weight")))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target, parts): the words wanted of every source and
    the expected copies of each of its documents, in parts."""
    s = saved(ranked_sources(sizes), "mix-weights")
    # A level is the exact fraction num / (100 * den): what the capped sources leave
    # of the budget over the weights of the others. One row a round reaches the driver.
    total, den = s.agg(F.sum(_big("source_size")), F.sum(_big("weight"))).first()
    total, den = int(total or 0), int(den or 0)
    num = BUDGET_PERCENT * total
    count = -1
    while den:
        capped = (_big("source_size") * F.lit(100 * CAP) * F.lit(den).cast("decimal(20,0)")
                  <= F.lit(num).cast("decimal(38,0)") * F.col("weight"))
        r = s.agg(F.count_if(capped).alias("n"), F.sum(F.when(capped, _big("source_size"))).alias("size"),
                  F.sum(F.when(~capped, F.col("weight"))).alias("open")).first()
        if r["n"] == count:
            break
        count, num = r["n"], BUDGET_PERCENT * total - 100 * CAP * int(r["size"] or 0)
        den = int(r["open"] or 0)
    if not den:  # every source is at its cap
        capped, num, den = F.lit(True), 0, 1
    level = F.lit(num).cast("decimal(30,0)") * F.col("weight")
    target = F.when(capped, (F.col("source_size") * CAP).cast("double")).otherwise(
        level.cast("double") / F.lit(float(100 * den)))
    share = F.expr(f"(cast({num} as decimal(20,0)) * weight * cast({PARTS} as decimal(10,0))) "
                   f"div (cast(source_size as decimal(19,0)) * cast({100 * den} as decimal(18,0)))")
    parts = F.when(F.col("source_size") == 0, F.lit(0)).when(capped, F.lit(CAP * PARTS)).otherwise(share)
    return s.select("source", "source_size", target.alias("target"), parts.cast("long").alias("parts"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and source of every document."""
    t = F.coalesce(F.col(text), F.lit(""))
    # Ordered by size, then by a digest of id and text; md5 spreads any ids.
    rows = saved(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source).alias("source"), F.size(words_of(t)).cast("long").alias("size"),
        F.md5(F.encode(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), t), "UTF-8")).alias("h")),
        "mix-rows")
    per_size = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("_n"))
    sizes = per_size.groupBy("source").agg(F.sum(F.col("size") * F.col("_n")).alias("source_size"))
    # Joined by a code of its own, since a null source is a source too.
    code = F.sha2(F.encode(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")), "UTF-8"), 256)
    offset = F.expr(f"cast(conv(substr(md5(concat('{SEED}:', coalesce(source, ''))), 1, 8), 16, 10) as long) "
                    f"* {PARTS}L div {1 << 32}L")
    targets = source_targets(sizes).withColumns({"_s": code, "_offset": offset}).drop("source")
    by_size = Window.partitionBy("_s").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each source and size: rows before that size, in copies' parts.
    starts = (per_size.withColumn("_s", code).join(targets, "_s")
              .withColumn("_start", F.coalesce(F.sum(_big("_n") * F.col("parts")).over(by_size), _big(F.lit(0))))
              .withColumn("_key", F.concat_ws(":", "_s", "size"))
              .select("_key", "_start", "_offset", "parts", "source_size", "target"))
    total = rows.count()
    buckets = max(256, min(65_536, total // BUCKET_ROWS))
    keyed = rows.withColumn("_key", F.concat_ws(":", code, "size"))
    # Runs of leading digits of the digest: buckets in the order of the digests.
    bucket = F.expr(f"cast(conv(substr(h, 1, 4), 16, 10) as long) * {buckets} div 65536")
    rank = with_rank(keyed, ["_key"], bucket, [F.col("h"), F.asc_nulls_first("doc_id")], "_rank")
    low = F.col("_start") + _big("_rank") * F.col("parts") + F.col("_offset")
    crossed = F.expr("cast((_low + parts) div {0} - _low div {0} as long)".format(PARTS))
    return (rank.join(starts, "_key").withColumn("_low", low.cast("decimal(38,0)")).withColumn("copies", crossed)
            .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                    "copies", "source"))


def repeated(docs: DataFrame, mix: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with every row as often as the mix (of a table with unique ids)
    takes it."""
    names = docs.columns
    rows = docs.select(F.col(id_col).alias("_i"), F.struct(*names).alias("_doc"))
    wanted = mix.filter("copies > 0").select(F.col("doc_id").alias("_j"), "copies")
    return (rows.join(wanted, F.col("_i").eqNullSafe(F.col("_j")))
            .select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_k"))
            .select(*[F.col("_doc").getField(c).alias(c) for c in names]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: words that the mix takes of every document."""
    return mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


#: The same mix in DuckDB; the water level by one ordered pass over the sources.
SQL = f"""
WITH d AS MATERIALIZED (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS size FROM d GROUP BY source),
w AS (SELECT *, {list(WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1]::HUGEINT AS w FROM s),
b AS (SELECT *, sum(size) OVER () AS t, sum(w) OVER () AS wt,
    coalesce(sum(size) OVER before, 0) AS size_before, coalesce(sum(w) OVER before, 0) AS w_before
  FROM w WINDOW before AS (ORDER BY size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, bool_and(100 * {CAP} * size * (wt - w_before) <= ({BUDGET_PERCENT} * t - 100 * {CAP} * size_before) * w)
    OVER (ORDER BY size::DOUBLE / w, source NULLS LAST ROWS UNBOUNDED PRECEDING) AS capped FROM b),
l AS (SELECT coalesce({BUDGET_PERCENT} * max(t) - 100 * {CAP} * coalesce(sum(size) FILTER (capped), 0), 0)::HUGEINT AS num,
    coalesce(sum(w) FILTER (NOT capped), 0)::HUGEINT AS den FROM c),
g AS (SELECT source, size AS source_size,
    CASE WHEN capped THEN ({CAP} * size)::DOUBLE ELSE (num * w)::DOUBLE / (100 * den)::DOUBLE END AS target,
    (CASE WHEN size = 0 THEN 0 WHEN capped THEN {CAP * PARTS} ELSE num * w * {PARTS} // (100 * den * size) END)::HUGEINT AS parts,
    ('0x' || substr(md5('{SEED}:' || coalesce(source, '')), 1, 8))::HUGEINT * {PARTS} // {1 << 32} AS u
  FROM c, l),
e AS (SELECT doc_id, d.size, source_size, target, parts, u + coalesce(sum(parts) OVER (PARTITION BY d.source
    ORDER BY d.size, h, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
  (size * ((low + parts) // {PARTS} - low // {PARTS}))::BIGINT AS taken FROM e
"""
