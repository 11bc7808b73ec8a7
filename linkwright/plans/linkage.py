"""The linkage queries: each applies one operator to the directory derived from the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from ..operators import blocking, decide, features, keyed, metrics, model, prepare
from ..sources import directory, files, sinks
from .oracle import ROUTED

SOURCES = ("source1", "source2", "source3")
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return directory.read_directory(spark, sf_dir, source)


def prepared(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Records are dealt out before they are prepared: a source may be one file, so one task."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return prepare.prepare(raw(spark, sf_dir, source).repartition(parts, "id"), ascii_only=True)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def everything(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union([prepared(spark, sf_dir, s) for s in SOURCES])


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1 = raw(spark, sf_dir, "source1").select(F.col("id").alias("source1_id"), "k")
    return union([s1.join(raw(spark, sf_dir, s).select("k", F.col("id").alias("target_id")), "k").select("source1_id", F.lit(s).alias("target_source"), "target_id") for s in SOURCES[1:]])


def classed(spark: SparkSession, sf_dir: str, source: str, *wanted: str) -> tuple[DataFrame, DataFrame]:
    """Classes of equal records, prepared, with the columns ``wanted`` (all if none), and the members of each. Both are written, as several readers use them."""
    records, parts = raw(spark, sf_dir, source), int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = blocking.with_signature(prepare.prepare(prepare.classes(records).repartition(parts, "id"), ascii_only=True))
    fields = [f for f in prepare.FIELDS if f in records.columns]
    rows = files.cut(rows.select(*dict.fromkeys([*fields, "copies", *wanted])) if wanted else rows)
    return rows, files.cut(prepare.members(records, rows))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of both target sources, found by classes of equal records. They are written once, as their readers may use them several times."""
    sides = {s: classed(spark, sf_dir, s, *blocking.SLIM, "signature") for s in SOURCES}
    s1, of_s1 = sides["source1"]
    return files.cut(union([blocking.expand(blocking.class_pairs(s1, *sides[s], s), of_s1) for s in SOURCES[1:]]))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with the blocking score as confidence."""
    return candidates(spark, sf_dir).select("source1_id", "target_source", "target_id", F.col("blocking_score").alias("confidence"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "source1").select(F.col("id").alias("source1_id"))


def featured(spark: SparkSession, sf_dir: str, then: Callable[[DataFrame], DataFrame] = lambda x: x) -> DataFrame:
    """Signals of all candidates, made once for each two classes of equal records; ``then`` is what is made of a pair's signals alone."""
    sides = {s: classed(spark, sf_dir, s) for s in SOURCES}
    every = union([x.select("brand_name", "copies") for x, _ in sides.values()])
    (s1, of_s1), flagged = sides["source1"], {s: prepare.flag_chains(x, every) for s, (x, _) in sides.items()}
    table = files.cut(features.idf(s1))
    made = lambda s: then(features.compute(files.cut(blocking.class_pairs(s1, *sides[s], s)), flagged["source1"], flagged[s], table))
    return union([blocking.expand(made(s), of_s1) for s in SOURCES[1:]])


def with_only(*columns) -> Callable[[DataFrame], DataFrame]:
    """For ``featured``: a pair's keys and these columns."""
    return lambda x: x.select("source1_id", "target_source", "target_id", "targets", "listed", *columns)


@query
def directory_(spark, sf_dir):
    return union([raw(spark, sf_dir, s) for s in SOURCES])


@query
def name_normalize(spark, sf_dir):
    return everything(spark, sf_dir).select("id", "normalized_business_name", "brand_name", "legal_form")


@query
def address_parse(spark, sf_dir):
    return everything(spark, sf_dir).select("id", "normalized_address", "core_address", "landmark_text", "street_number", "street_name", "postal_code_normalized", "country_normalized", "postal_prefix")


@query
def text_normalize(spark, sf_dir):
    """Unicode normal form of whole documents; their letters are beyond SQL."""
    return read(spark, sf_dir, "documents").select("doc_id", T.normalize("text").alias("normalized"))


@query
def routing_extract(spark, sf_dir):
    rows = spark.sql(ROUTED, customer=read(spark, sf_dir, "customer"))
    return rows.select("c_custkey", T.routing("address").alias("r")).select("c_custkey", "r.cleaned", "r.routing", F.array_join(F.array_sort("r.numbers"), ",").alias("numbers"))


@query
def soundex_codes(spark, sf_dir):
    tokens = read(spark, sf_dir, "part").select(F.explode(F.regexp_extract_all(F.lower(F.concat_ws(" ", "p_name", "p_type")), F.lit("[a-z0-9]+"), F.lit(0))).alias("token")).distinct()
    return tokens.select("token", T.soundex("token").alias("code"))


@query
def phonetic_similarity(spark, sf_dir):
    name = lambda i: read(spark, sf_dir, "part").select(F.get(F.split("p_name", " "), F.lit(i)).alias("n")).distinct()
    a, b = name(0).withColumnRenamed("n", "a"), name(1).withColumnRenamed("n", "b")
    pairs = a.join(b, F.substring("a", 1, 1) == F.substring("b", 1, 1))
    return pairs.select("a", "b", F.round(S.phonetic(F.array("a"), F.array("b")), 6).alias("similarity"))


@query
def shingles(spark, sf_dir):
    names = read(spark, sf_dir, "part").select("p_name").distinct()
    return names.select("p_name", F.array_join(F.array_sort(T.shingles("p_name")), "|").alias("grams"))


@query
def minhash_signature(spark, sf_dir):
    return blocking.with_signature(prepared(spark, sf_dir, "source1")).select("id", F.array_join("signature", "-").alias("signature"))


@query
def lsh_pairs(spark, sf_dir):
    (s1, of_s1), (target, of_target) = (classed(spark, sf_dir, s, "id", "country_normalized", "signature") for s in ("source1", "source2"))
    return blocking.pairs_by_minhash(s1, target, of_s1, of_target)


@query
def idf_table(spark, sf_dir):
    return features.idf(prepared(spark, sf_dir, "source1")).select("token", "df", F.round("idf", 6).alias("idf"))


@query
def token_candidates(spark, sf_dir):
    found = blocking.by_token(prepared(spark, sf_dir, "source1"), prepared(spark, sf_dir, "source2"))
    return found.groupBy("source1_id", "target_id").agg(F.round(F.sum("weight"), 6).alias("weight"))


@query
def postal_candidates(spark, sf_dir):
    return blocking.by_field(prepared(spark, sf_dir, "source1"), prepared(spark, sf_dir, "source3"), "postal_prefix", 1.5).select("source1_id", "target_id")


@query
def street_candidates(spark, sf_dir):
    return blocking.by_field(prepared(spark, sf_dir, "source1"), prepared(spark, sf_dir, "source3"), "street_number", 0.5).select("source1_id", "target_id")


@query
def dense_topk(spark, sf_dir):
    """The 20 nearest vectors of every vector whose id is divisible by 100 (the stated query set)."""
    vectors = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return blocking.by_vector(vectors.where("id % 100 = 0"), vectors).select("source1_id", "target_id", "weight")


@query
def blocking_topk(spark, sf_dir):
    found = candidates(spark, sf_dir)
    return found.withColumn("blocking_methods", F.array_join("blocking_methods", ",")).withColumn("blocking_score", F.round("blocking_score", 6))


@query
def blocking_stats(spark, sf_dir):
    return blocking.statistics(candidates(spark, sf_dir), truth(spark, sf_dir))


@query
def pair_features(spark, sf_dir):
    return featured(spark, sf_dir, with_only(*[F.round(n, 6).alias(n) for n in features.FEATURES]))


@query
def rule_scores(spark, sf_dir):
    return featured(spark, sf_dir, lambda x: with_only("rule_applied")(features.apply_rules(x)))


@query
def hard_negatives(spark, sf_dir):
    rows = files.cut(featured(spark, sf_dir, with_only(*[F.round(n, 6).alias(n) for n in model.HARDNESS])))
    return model.mine(rows, truth(spark, sf_dir)).select("source1_id", "target_source", "target_id", "label")


@query
def chain_brands(spark, sf_dir):
    return everything(spark, sf_dir).where("brand_name <> ''").groupBy("brand_name").agg(F.count("*").alias("n")).where("n >= 3")


@query
def truth_normalize(spark, sf_dir):
    typed = truth(spark, sf_dir).groupBy("source1_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "target_source", "target_id"))), ",").alias("match_ids"))
    return files.normalize_truth(typed, raw(spark, sf_dir, "source1"), {s: raw(spark, sf_dir, s) for s in SOURCES[1:]})


@query
def cardinality_infer(spark, sf_dir):
    s1, s2 = raw(spark, sf_dir, "source1"), raw(spark, sf_dir, "source2")
    named = s2.select(F.col("id").alias("target_id"), F.concat(F.lower(F.replace("business_name", F.lit(" LIMITED"), F.lit(""))), F.lit(" Ltd")).alias("business_name"))
    same = decide.cover(s1.select(F.col("id").alias("source1_id"), "business_name"), named, "business_name", "source2")
    pairs = same.unionByName(truth(spark, sf_dir).where("target_source = 'source3'"))
    return decide.infer_cardinality(pairs)


@query
def split_holdout(spark, sf_dir):
    return model.hold_out(raw(spark, sf_dir, "source1").select("id"))


@query
def unique_target_winner(spark, sf_dir):
    return decide.unique_targets(scored(spark, sf_dir))


@query
def unique_s1_winner(spark, sf_dir):
    return decide.unique_sources(scored(spark, sf_dir))


@query
def greedy_one_to_one(spark, sf_dir):
    return decide.greedy(scored(spark, sf_dir).where("confidence > 0.6"))


@query
def max_weight_assignment(spark, sf_dir):
    return decide.assign(scored(spark, sf_dir), 0.6)


@query
def threshold_sweep(spark, sf_dir):
    return metrics.sweep(scored(spark, sf_dir), truth(spark, sf_dir), entities(spark, sf_dir), {s: "one_to_many" for s in SOURCES[1:]})


@query
def tune_threshold(spark, sf_dir):
    return metrics.tune(threshold_sweep(spark, sf_dir))


def matched(spark, sf_dir):
    return decide.resolve(scored(spark, sf_dir), 0.6, {s: "one_to_many" for s in SOURCES[1:]})


@query
def macro_fbeta(spark, sf_dir):
    return metrics.fbeta(truth(spark, sf_dir), matched(spark, sf_dir), entities(spark, sf_dir))


@query
def diagnostics(spark, sf_dir):
    found = candidates(spark, sf_dir)
    pairs = found.select("source1_id", "target_source", "target_id", F.col("blocking_score").alias("confidence"))
    return metrics.diagnostics(truth(spark, sf_dir), found, decide.resolve(pairs, 0.6, {s: "one_to_many" for s in SOURCES[1:]}))


@query
def submission_matches(spark, sf_dir):
    return sinks.id_lists(matched(spark, sf_dir), entities(spark, sf_dir), "matched_entity_ids")


@query
def submission_candidates(spark, sf_dir):
    return sinks.id_lists(candidates(spark, sf_dir), entities(spark, sf_dir), "candidate_entity_ids")


@query
def submission_validate(spark, sf_dir):
    found = candidates(spark, sf_dir)
    pairs = found.select("source1_id", "target_source", "target_id", F.col("blocking_score").alias("confidence"))
    m, c, _ = sinks.submission(decide.unique_targets(pairs), found, entities(spark, sf_dir))
    rows = lambda x: files.cut(x.toDF("s1", "ids"))  # noqa: E731  read once for each kind of fault
    targets = union([raw(spark, sf_dir, s).select("id") for s in SOURCES[1:]])
    return sinks.check_lists(rows(m), entities(spark, sf_dir), targets, rows(c))


@query
def output_integrity(spark, sf_dir):
    found = candidates(spark, sf_dir)
    pairs = found.select("source1_id", "target_source", "target_id", F.col("blocking_score").alias("confidence"))
    targets = union([raw(spark, sf_dir, s).select("id") for s in SOURCES[1:]])
    return sinks.integrity(found, decide.unique_targets(pairs), raw(spark, sf_dir, "source1"), targets, 60)


@query
def evaluation_rates(spark, sf_dir):
    found = candidates(spark, sf_dir)
    pairs = found.select("source1_id", "target_source", "target_id", F.col("blocking_score").alias("confidence"))
    return metrics.rates(truth(spark, sf_dir), found, decide.resolve(pairs, 0.6, {s: "one_to_many" for s in SOURCES[1:]}), entities(spark, sf_dir))


@query
def keyed_match_simple(spark, sf_dir):
    return _keyed(spark, sf_dir, "simple")


@query
def keyed_match_strict(spark, sf_dir):
    return _keyed(spark, sf_dir, "strict")


def _keyed(spark, sf_dir, mode):
    side = lambda s: raw(spark, sf_dir, s).withColumnRenamed("k", "pos")
    return keyed.match(side("source1"), {s: side(s) for s in SOURCES[1:]}, mode)


@query
def schema_summary(spark, sf_dir):
    return files.summary({s: raw(spark, sf_dir, s) for s in SOURCES})


@query
def bounded_load(spark, sf_dir):
    s1 = raw(spark, sf_dir, "source1").withColumnRenamed("k", "pos")
    return files.bounded(s1, 100, s1.where("pos % 10 = 3")).select("id", F.col("pos").alias("k"))


@query
def rf_scores(spark, sf_dir):
    """A forest fitted on the pairs of records that are not held out, applied to those that are."""
    rows = files.cut(featured(spark, sf_dir))
    split = files.cut(model.hold_out(raw(spark, sf_dir, "source1").select("id")).withColumnRenamed("id", "source1_id"))
    fit_rows, rest = rows.join(split.where("not validation"), "source1_id", "left_semi"), rows.join(split.where("validation"), "source1_id", "left_semi")
    fitted = model.fit(files.cut(model.mine(fit_rows, truth(spark, sf_dir))))
    return model.score(fitted, rest).select("source1_id", "target_source", "target_id", F.round("confidence", 6).alias("confidence"), "rule_applied", "decision_reason")


QUERIES["directory"] = QUERIES.pop("directory_")
