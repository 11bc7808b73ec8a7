"""The two bounded exact-key matchers from files to result files: no training, no model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keyed
from ..sources import files
from .dataset import SOURCES
from .storage import Storage

FIELDS = ("id", "business_name", "business_address", "country")


def positional(spark: SparkSession, path: str) -> DataFrame:
    """id, the three fields and pos: the first four cells of each line after the first, whatever the header
    says. Shorter lines have null fields."""
    lines = spark.read.text(path).select(F.split(F.regexp_replace("value", "\r$", ""), "\t", -1).alias("c"), F.monotonically_increasing_id().alias("pos"))
    whole = F.size("c") >= len(FIELDS)
    return lines.where("pos > 0").select(F.get("c", F.lit(0)).alias("id"), *(F.when(whole, F.get("c", F.lit(i))).alias(f) for i, f in enumerate(FIELDS) if i), "pos")


def match_files(spark: SparkSession, data_dir: str, output_dir: str, mode: str = "simple") -> dict:
    """Both result files (in the order of the source-1 file), in the folder and in its ``submission``, the archive, and counts.

    Lists are in probing order, source 2 before source 3. A short source-1 line has empty lists; a
    short target line is no target."""
    if mode not in ("simple", "strict"):
        raise ValueError(f"no mode {mode!r}")
    out = Storage(spark, output_dir)
    raw = {s: positional(spark, f"{data_dir.rstrip('/')}/test_{s}.tsv") for s in SOURCES}
    whole = {s: x.where("country is not null") for s, x in raw.items()}
    found = files.cut(keyed.match(whole["source1"], {s: whole[s] for s in SOURCES[1:]}, mode))
    order = F.struct("target_source", "rank", "target_id")
    listed = lambda keep: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(keep, order))), lambda x: x["target_id"]), ",")
    lists = found.groupBy("source1_id").agg(listed(F.col("matched")).alias("matched_entity_ids"), listed(F.lit(True)).alias("candidate_entity_ids"))
    entities = raw["source1"].select(F.col("id").alias("source1_id"), "pos")
    rows = files.cut(entities.join(lists, "source1_id", "left").na.fill(""))
    for column, name in (("matched_entity_ids", "matching_results.tsv"), ("candidate_entity_ids", "candidate_pairs.tsv")):
        table = rows.select("pos", F.col("source1_id").alias("source1_entity_id"), column)
        for folder in ("", "submission/"):
            out.put_table(folder + name, table, ["pos"], hidden=("pos",))
    out.put_zip("submission.zip", {f"output/{n}": n for n in ("matching_results.tsv", "candidate_pairs.tsv")})
    n = rows.count()
    pairs = found.agg(F.count_if("matched").alias("matches"), F.count("*").alias("candidates"), F.count_distinct(F.when(F.col("matched"), F.col("source1_id"))).alias("matched_entities")).first()
    counts = {"entities": n, "matched_entities": pairs["matched_entities"], "match_pairs": pairs["matches"], "candidate_pairs": pairs["candidates"]}
    return counts | {"matches_per_matched_entity": round(pairs["matches"] / max(1, pairs["matched_entities"]), 6), "candidates_per_entity": round(pairs["candidates"] / max(1, n), 6)}
