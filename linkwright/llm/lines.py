"""Line dedup: overlapping three-line windows, found anywhere in the corpus.

A text is split at newlines. Every three consecutive lines are one window, told by two 64-bit hashes
of the lines. A window's first occurrence (by doc_id, then the row's hash, then line) stays; each
later one covers its three lines, and covered lines, merged into runs, are removed. Windows of blank
lines only never count. Texts of fewer than three lines have no window and stay as they are.

A null text is one empty line. Rows that agree in doc_id and text share their first occurrences, so
both stay or both lose the same lines. A null doc_id comes before all others. Empty tables give no
rows. Extra columns are carried along untouched.

A window that stands in a third of all rows is counted with map-side sums and joined with salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import salted_join, shielded, table

WINDOW = 3


def _lines(text: str | Column = "text") -> Column:
    return F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "\n", -1)


def _row_key() -> Column:
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def windows(docs: DataFrame) -> DataFrame:
    """doc_id, rid (hash of doc_id and text), pos (from 0), h1, h2: a row for each window."""
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _row_key().alias("rid"), _lines().alias("lines")).where(F.size("lines") >= WINDOW)
    blank = F.length(F.trim(F.concat(*[F.get("lines", F.col("pos") + k) for k in range(WINDOW)]))) == 0
    rows = base.select("*", F.explode(F.sequence(F.lit(0), F.size("lines") - WINDOW)).alias("pos")).where(~blank)
    part = [F.get("lines", F.col("pos") + k) for k in range(WINDOW)]
    return rows.select("doc_id", "rid", "pos", F.xxhash64(*part).alias("h1"), F.xxhash64(F.lit(1), *reversed(part)).alias("h2"))


def later_windows(docs: DataFrame) -> DataFrame:
    """doc_id, rid, later (sorted positions of windows that occurred before)."""
    found = windows(docs)
    here = F.struct("doc_id", "rid", "pos")
    first = found.groupBy("h1", "h2").agg(F.min(here).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = salted_join(found, first.withColumnRenamed("h2", "_h2"), "h1").where((F.col("h2") == F.col("_h2")) & (here > F.col("first")))
    return later.groupBy("doc_id", "rid").agg(F.array_sort(F.collect_set("pos")).alias("later"))


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with _lines, _later and _spans (runs of covered lines: s, first; e, past the last)."""
    later = later_windows(docs).select(F.col("doc_id").alias("_id"), F.col("rid").alias("_rid"), "later")
    keyed = docs.withColumn("_key", _row_key())
    joined = keyed.join(later, (F.col("_key") == F.col("_rid")) & F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")), "left")
    joined = joined.withColumn("_later", F.coalesce("later", F.array().cast("array<int>"))).drop("later", "_id", "_rid", "_key")
    pos = F.col("_later")
    starts = F.filter(pos, lambda p, i: (i == 0) | (p > F.get(pos, i - 1) + WINDOW))
    ends = F.filter(pos, lambda p, i: (i == F.size(pos) - 1) | (F.get(pos, i + 1) > p + WINDOW))
    return joined.withColumn("_spans", F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), (e + WINDOW).alias("e")))).withColumn("_lines", _lines())


def _kept() -> Column:
    """The lines outside the runs, taken as the slices between them."""
    spans, lines = F.col("_spans"), F.col("_lines")
    cuts = F.transform(
        F.sequence(F.lit(0), F.size(spans)),
        lambda i: F.struct(F.coalesce(F.get(spans, i - 1)["e"], F.lit(0)).alias("a"), F.coalesce(F.get(spans, i)["s"], F.size(lines)).alias("b")),
    )
    return F.flatten(F.transform(cuts, lambda c: F.slice(lines, c["a"] + 1, c["b"] - c["a"])))


def report(docs: DataFrame) -> DataFrame:
    got = with_spans(docs.select("doc_id", "text"))
    removed = F.aggregate("_spans", F.lit(0), lambda a, x: a + x["e"] - x["s"])
    return got.select(
        "doc_id",
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.size("_later").cast("bigint").alias("n_windows"),
        removed.cast("bigint").alias("n_removed"),
        F.size("_spans").cast("bigint").alias("n_spans"),
        F.sha2(F.array_join(_kept(), "\n").cast("binary"), 256).alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without later windows' lines; a document of which nothing but blanks is left goes.
    Columns stay (n_chars, if there, is set anew); documents without repeats are unchanged."""
    inner = shielded(docs)
    columns = inner.columns
    got = with_spans(inner)
    changed = F.size("_spans") > 0
    got = got.withColumn("text", F.when(changed, F.array_join(_kept(), "\n")).otherwise(F.col("text"))).where(~changed | (F.length(F.trim("text")) > 0))
    if "n_chars" in columns:
        got = got.withColumn("n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return got.select(columns).toDF(*docs.columns)


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


SQL = """
WITH l AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
p AS (
  SELECT doc_id, lines, unnest(range(0, greatest(len(lines) - 2, 0))) AS pos FROM l),
w AS (
  SELECT doc_id, pos, md5(to_json([lines[pos + 1], lines[pos + 2], lines[pos + 3]])) AS h
  FROM p WHERE trim(lines[pos + 1] || lines[pos + 2] || lines[pos + 3]) <> ''),
r AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY h ORDER BY doc_id, pos) AS k FROM w),
later AS (SELECT doc_id, pos FROM r WHERE k > 1),
cov AS (SELECT DISTINCT doc_id, pos + d AS i FROM later, (SELECT unnest([0, 1, 2]) AS d)),
runs AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE prev IS NULL OR i > prev + 1) AS n_spans
  FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM cov) GROUP BY doc_id),
allp AS (SELECT doc_id, lines, unnest(range(0, len(lines))) AS i FROM l),
kept AS (
  SELECT a.doc_id, string_agg(a.lines[a.i + 1], chr(10) ORDER BY a.i) AS t
  FROM allp a LEFT JOIN cov c ON a.doc_id = c.doc_id AND a.i = c.i WHERE c.i IS NULL GROUP BY a.doc_id),
n AS (SELECT doc_id, count(*) AS n_windows FROM later GROUP BY doc_id)
SELECT l.doc_id, CAST(len(l.lines) AS BIGINT) AS n_lines, CAST(coalesce(n.n_windows, 0) AS BIGINT) AS n_windows,
  CAST(coalesce(runs.n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(runs.n_spans, 0) AS BIGINT) AS n_spans,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM l LEFT JOIN n ON l.doc_id = n.doc_id LEFT JOIN runs ON l.doc_id = runs.doc_id LEFT JOIN kept ON l.doc_id = kept.doc_id
"""
