r"""Secret scans with corpus-wide ownership frequency: DataFrame functions only.

Base spans, leftmost and non-overlapping for each kind, in code points: ``assign`` (a password-like
name, a separator, a value of 6 or more), ``access`` (AKIA..., 20 or more), ``hex`` (24 or more). To
these the method adds ``generic`` candidates: runs of 20 or more of [A-Za-z0-9+/_=-] that hold lower
case, upper case and digits and touch no base span.

Each candidate value is hashed; hashes are counted by distinct owners and repositories over the whole
corpus, copies of a text being counted where the first of them (by repository) stands, as a copied document
does not make its secrets examples. A value that more than ``MAX_OWNERS`` owners or ``MAX_REPOS`` repositories
have is a widely copied example; the others are owner-specific, live-looking ones. A generic candidate
becomes a span only if it is live-looking.

Documents' ``source`` is taken as owner, source and language together as repository. Null texts are
empty; null owners count as one owner. Rows are told apart by a row number, so repeated doc_ids are
reported row by row. Empty tables give no rows; extra columns are ignored.

Distinct (hash, text) are formed with map-side sums before the count, and
spans of a hash that a third of all rows hold are dealt among salts when the counts are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, salted_join, table

#: Fixed patterns of the contract; a match is checked for its length afterwards.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run that fails with its first AKIA fails with any later one
HEX = r"[0-9a-f]{24,}"  # runs are maximal either way
GENERIC = r"[A-Za-z0-9+/_=-]{20,}"
#: A value is a widely copied example if more owners, or more repositories, than these have it.
MAX_OWNERS = 2
MAX_REPOS = 4
#: Matches whose positions are summed at a time.
RUN = 128


def matches(text: Column, pattern: str) -> Column:
    """Array of (gap, found): each match and the number of code points between the one before and it."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    pairs = F.zip_with(gaps, found, lambda g, f: F.struct(F.length(g).alias("gap"), f.alias("found")))
    # most texts have no match: they are not split
    return F.when(F.size(found) == 0, F.array().cast("array<struct<gap:int,found:string>>")).otherwise(pairs)


def located(name: str) -> Column:
    """Array of (start, end, found), in code points, from a column of ``matches``.

    Spark copies what an aggregate has gathered at each step. So positions are summed over runs of ``RUN``
    matches, and then within each run from its own start. The column is named more than once, so that Spark
    computes it once and not in every run."""
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")
    runs = F.sequence(F.lit(0), F.floor((F.size(name) - 1) / RUN).cast("int"))
    run = lambda i: F.slice(name, i * RUN + 1, F.lit(RUN))
    sums = F.transform(runs, lambda i: F.aggregate(run(i), F.lit(0), lambda a, x: a + x["gap"] + F.length(x["found"])))
    starts = F.aggregate(sums, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))

    def add(a, x):
        begin = a["at"] + x["gap"]
        end = begin + F.length(x["found"])
        return F.struct(end.alias("at"), F.concat(a["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"), x["found"].alias("found")))).alias("spans"))

    spans = F.zip_with(F.slice(starts, F.lit(1), F.size(runs)), runs, lambda at, i: F.aggregate(run(i), F.struct(at.alias("at"), none.alias("spans")), add, lambda a: a["spans"]))
    return F.when(F.size(name) == 0, none).otherwise(F.flatten(spans))


def _tag(spans: Column, order: int, kind: str, value) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(order).alias("o"), x["end"].alias("end"), F.lit(kind).alias("kind"), F.xxhash64(value(x["found"])).alias("h")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def candidates(docs: DataFrame) -> DataFrame:
    """row, doc_id, repo, owner, th (hash of the text), base and generic (sorted arrays of spans with hashes)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("owner"),
        F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))).alias("repo"),
        F.xxhash64(text).alias("th"),
        *(matches(text, p).alias(n) for n, p in (("a", ASSIGN), ("k", ACCESS), ("x", HEX), ("g", GENERIC))),
    )
    rows = rows.select("row", "doc_id", "owner", "repo", "th", *(located(n).alias(n) for n in ("a", "k", "x", "g")))
    value = lambda f: F.regexp_extract(f, ASSIGN, 1)
    whole = lambda f: f
    base = F.concat(_tag(F.filter("a", lambda m: F.length(value(m["found"])) >= 6), 0, "assign", value), _tag(F.col("k"), 1, "access", whole), _tag(F.col("x"), 2, "hex", whole))
    rows = rows.select("row", "doc_id", "owner", "repo", "th", F.array_sort(base).alias("base"), "g")
    mixed = lambda m: m["found"].rlike("[a-z]") & m["found"].rlike("[A-Z]") & m["found"].rlike("[0-9]")
    free = F.filter("g", lambda m: mixed(m) & ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return rows.select("row", "doc_id", "owner", "repo", "th", "base", _tag(free, 3, "generic", whole).alias("generic"))


def scan(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """One row per row of ``docs``: base counts and digest, all spans, and how many are live or examples."""
    found = cut(candidates(docs))
    spans = found.where((F.size("base") > 0) | (F.size("generic") > 0)).select("row", "owner", "repo", "th", F.explode(F.concat("base", "generic")).alias("s")).select("row", "owner", "repo", "th", F.col("s.h").alias("h"), "s")
    owned = spans.groupBy("h", "th").agg(F.min(F.struct("repo", "owner")).alias("o"))
    counts = owned.groupBy("h").agg(F.count_distinct("o.repo").alias("repos"), F.count_distinct("o.owner").alias("owners"))
    # the counts grow with the corpus: never a broadcast, whatever their estimated size
    judged = salted_join(spans.select("row", "h", "s"), counts.hint("merge"), "h").withColumn("live", (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos))
    by_row = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(F.col("live") | (F.col("s.o") < 3), F.col("s")))).alias("spans"),
        F.count_if("live").alias("n_live"),
        F.count_if(~F.col("live")).alias("n_example"),
    )
    count = lambda k: F.size(F.filter("base", lambda b: b["o"] == k)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    return found.join(by_row, "row", "left").select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce(_joined(F.col("spans")), F.lit("")).alias("spans"),
        F.coalesce("n_live", zero).alias("n_live"),
        F.coalesce("n_example", zero).alias("n_example"),
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _found(order: int, kind: str, pattern: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"SELECT rid, {order} AS o, '{kind}' AS kind, regexp_extract_all(t, '{quoted}') AS f, string_split_regex(t, '{quoted}') AS g FROM d"


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner, coalesce(source, '') || '/' || coalesce(lang, '') AS repo FROM documents),
m AS (
  SELECT rid, o, kind, unnest(f) AS found, unnest(g[1 : len(f)]) AS gap, generate_subscripts(f, 1) AS j
  FROM ({" UNION ALL ".join(_found(i, k, p) for i, (k, p) in enumerate((("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("generic", GENERIC))))}) WHERE len(f) > 0),
e AS (SELECT *, CAST(sum(length(gap) + length(found)) OVER (PARTITION BY rid, o ORDER BY j) AS BIGINT) AS z FROM m),
x AS (SELECT rid, o, kind, found, z - length(found) AS a, z, CASE WHEN o = 0 THEN regexp_extract(found, '{ASSIGN.replace("'", "''")}', 1) ELSE found END AS v FROM e),
base AS (SELECT * FROM x WHERE o IN (1, 2) OR (o = 0 AND length(v) >= 6)),
generic AS (
  SELECT * FROM x WHERE o = 3 AND regexp_matches(found, '[a-z]') AND regexp_matches(found, '[A-Z]') AND regexp_matches(found, '[0-9]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = x.rid AND b.a < x.z AND x.a < b.z)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM generic),
own AS (SELECT v, t, min(struct_pack(repo := repo, owner := owner)) AS r FROM every JOIN d USING (rid) GROUP BY v, t),
counts AS (SELECT v, count(DISTINCT r.repo) AS repos, count(DISTINCT r.owner) AS owners FROM own GROUP BY v),
j AS (SELECT every.*, owners <= {MAX_OWNERS} AND repos <= {MAX_REPOS} AS live, kind || ':' || a || ':' || z AS s FROM every JOIN counts USING (v))
SELECT d.doc_id, count(*) FILTER (WHERE o = 0) AS n_assign, count(*) FILTER (WHERE o = 1) AS n_access, count(*) FILTER (WHERE o = 2) AS n_hex,
  sha256(coalesce(string_agg(s, ',' ORDER BY a, o) FILTER (WHERE o < 3), '')) AS base_sha256,
  coalesce(string_agg(s, ',' ORDER BY a, o) FILTER (WHERE o < 3 OR live), '') AS spans,
  count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_example
FROM d LEFT JOIN j USING (rid) GROUP BY d.rid, d.doc_id
"""
