"""Line-first cleaning with quality rules (native DataFrame functions only).

Every line is judged by punctuation, navigation and boilerplate rules; failing
lines are removed, and a document that loses more than ``max_lost`` of its
text is rejected. Document statistics (repeated lines, repeated 3-word
windows, symbols, length) give the base verdict first.

Everything is computed inside the row: no shuffle, no Python, one scan, in
batches of few rows (with Spark's 4,096 an executor's heap grew to its limit).

Defined results: a null or empty text has no words and fails the base rules; a
null id passes through; repeated rows give repeated results; an empty table
gives an empty result; other columns are left alone (result columns replace
input columns of the same name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import let, scan_in_small_batches, table, words_of

# --- fixed values -----------------------------------------------------------
#: A line of prose ends with one of these, then closing quotes or brackets.
TERMINAL = r"""[.!?…:;。！？]["'”’»)\]]*[\x20\x09-\x0D]*\z"""
SYMBOL = r"[#*$%&|<>]"
DOUBLED = r"[!?]{2}"
SEPARATOR = r"[|»›•·→]"
#: Phrases of page furniture and licence lines, lower case.
BOILERPLATE = (
    r"(cookie|javascript|lorem ipsum|privacy policy|terms of (use|service)|all rights reserved"
    r"|copyright|licensed under|click here|read more|sign (in|up)|log ?in|subscribe|newsletter"
    r"|share (this|on)|follow us|back to top|skip to content|powered by)")
# ----------------------------------------------------------------------------

#: Production parameters.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 50
MAX_SYMBOL_PERCENT = 5
MAX_DOUBLED_PERCENT = 3
MIN_SEPARATORS = 3
MAX_FURNITURE_CHARS = 200
MAX_UNENDED_CHARS = 200


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def line_passes(line: Column) -> Column:
    """True if the line passes every rule.

    punctuation: it ends a sentence (asked of lines up to ``MAX_UNENDED_CHARS``
    only: longer ones are prose anyway), and symbols or doubled marks are rare;
    navigation: fewer than ``MIN_SEPARATORS`` separators; boilerplate: a short
    line holds no phrase of page furniture."""
    size = F.length(line)
    punctuation = (((size > MAX_UNENDED_CHARS) | line.rlike(TERMINAL))
                   & (F.regexp_count(line, F.lit(SYMBOL)) * 100 <= size * MAX_SYMBOL_PERCENT)
                   & (F.regexp_count(line, F.lit(DOUBLED)) * 100 <= size * MAX_DOUBLED_PERCENT))
    navigation = F.regexp_count(line, F.lit(SEPARATOR)) < MIN_SEPARATORS
    boilerplate = (size > MAX_FURNITURE_CHARS) | ~F.lower(line).rlike(BOILERPLATE)
    return punctuation & navigation & boilerplate


def repeated_words(words: Column) -> Column:
    """Number of words inside 3-word windows that occur twice or more.

    Window hashes (64 bits, compared within one text only) are sorted with
    their positions; neighbours of equal hash are repeats, and the sorted
    positions then cover at most three words each: n log n for any text."""
    def windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        return F.sort_array(F.transform(at, lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p"))))

    def repeats(s: Column) -> Column:
        def at(j):
            h = F.get(s, j)["h"]
            same = (F.coalesce(h == F.get(s, j - 1)["h"], F.lit(False))
                    | F.coalesce(h == F.get(s, j + 1)["h"], F.lit(False)))
            return F.when(same, F.get(s, j)["p"])
        return F.sort_array(F.array_compact(F.transform(F.sequence(F.lit(0), F.size(s) - 1), at)))

    def covered(p: Column) -> Column:
        steps = F.sequence(F.lit(1), F.size(p) - 1)
        return F.when(F.size(p) == 0, F.lit(0)).when(F.size(p) == 1, F.lit(3)).otherwise(
            F.aggregate(steps, F.lit(3), lambda a, j: a + F.least(F.lit(3), F.get(p, j) - F.get(p, j - 1))))

    return let(words, lambda w: F.when(F.size(w) < 3, F.lit(0)).otherwise(
        let(windows(w), lambda s: let(repeats(s), covered))))


def apply_quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_lines_kept, base_failed, kept and ``clean_text``
    (the surviving lines, in order)."""
    scan_in_small_batches(docs.sparkSession)
    t = F.coalesce(F.col(text), F.lit(""))
    word_stats = let(words_of(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).cast("long").alias("n_repeat_words")))

    def chars(lines: Column) -> Column:
        return F.aggregate(lines, F.lit(0), lambda a, x: a + F.length(x))

    line_stats = let(F.filter(F.split(t, "\n"), has_word), lambda lines: let(
        F.filter(lines, line_passes), lambda good: F.struct(
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(good).cast("long").alias("n_lines_kept"),
            chars(lines).cast("long").alias("_all"),
            chars(good).cast("long").alias("_good"),
            F.array_join(good, "\n").alias("clean_text"))))
    out = (docs.withColumns({"_w": word_stats, "_l": line_stats})
           .withColumns({
               "n_words": F.col("_w.n_words"), "word_chars": F.col("_w.word_chars"),
               "n_symbols": F.regexp_count(t, F.lit(SYMBOL)).cast("long"),
               "n_dup_lines": F.col("_l.n_dup_lines"), "n_repeat_words": F.col("_w.n_repeat_words"),
               "n_lines": F.col("_l.n_lines"), "n_lines_kept": F.col("_l.n_lines_kept"),
               "clean_text": F.col("_l.clean_text"),
               "_all": F.col("_l._all"), "_good": F.col("_l._good")}))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    lost = (F.col("_all") - F.col("_good")) * 100 > F.col("_all") * MAX_LOST_PERCENT
    return (out.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & ~lost)
            .drop("_w", "_l", "_all", "_good"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: verdict and statistics of every document."""
    return apply_quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_lines_kept")


def _sql(text: str) -> str:
    return text.replace("'", "''")


SQL = f"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), tok AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM base
), win AS (
  SELECT rid, unnest(range(0, len(w) - 2)) AS i, w FROM tok WHERE len(w) >= 3
), grams AS (
  SELECT rid, i, [w[i + 1], w[i + 2], w[i + 3]] AS g FROM win
), rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c >= 2
), cov AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS o(k) GROUP BY rid
), ln AS (
  SELECT rid, list_filter(lines, lambda x:
           (length(x) > {MAX_UNENDED_CHARS} OR regexp_matches(x, '{_sql(TERMINAL)}'))
           AND len(regexp_extract_all(x, '{_sql(SYMBOL)}')) * 100 <= length(x) * {MAX_SYMBOL_PERCENT}
           AND len(regexp_extract_all(x, '{_sql(DOUBLED)}')) * 100 <= length(x) * {MAX_DOUBLED_PERCENT}
           AND len(regexp_extract_all(x, '{_sql(SEPARATOR)}')) < {MIN_SEPARATORS}
           AND (length(x) > {MAX_FURNITURE_CHARS}
                OR NOT regexp_matches(lower(x), '{_sql(BOILERPLATE)}'))) AS good
  FROM tok
), s AS (
  SELECT t.doc_id, len(t.w) AS n_words, length(array_to_string(t.w, '')) AS word_chars,
         len(regexp_extract_all(t.text, '{_sql(SYMBOL)}')) AS n_symbols,
         len(t.lines) - len(list_distinct(t.lines)) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words, len(t.lines) AS n_lines, len(l.good) AS n_lines_kept,
         coalesce(list_sum(list_transform(t.lines, lambda x: length(x))), 0) AS a,
         coalesce(list_sum(list_transform(l.good, lambda x: length(x))), 0) AS g
  FROM tok t LEFT JOIN cov c USING (rid) JOIN ln l USING (rid)
), v AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM s
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT ((a - g) * 100 > a * {MAX_LOST_PERCENT}) AS kept,
       CAST(n_lines AS BIGINT) AS n_lines, CAST(n_lines_kept AS BIGINT) AS n_lines_kept
FROM v
"""
