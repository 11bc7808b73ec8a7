"""Near-dedup at a stated similarity: one document of each group stays.

First come the links of ``simhash``: 64-bit fingerprints within two bits, each verified by the shingle
sets (below). On five-word shingles, texts at a similarity (Jaccard, of shingle sets) of 0.8 differ in 9
bits on average and in up to 14, which no split into blocks can serve; and a fingerprint counts repeats,
so texts of equal shingle sets may differ in half its bits. So candidates of nodes that are not yet in one
group come from blocks of a longer fingerprint too: distinct shingles'
hashes are dealt into ``BINS`` bins by their leading bits, each bin keeps its least hash, and blocks of
``ROWS`` bins are the join keys (texts at 0.8 share one with a chance of 0.998). All candidates whose
numbers of distinct shingles allow it are verified: by the whole shingle sets up to ``SKETCH`` distinct
shingles. Beyond, the least ``SKETCH`` hashes of both give an estimate with a standard error of 0.0125 at
most near 0.8; it settles pairs that are ``MARGIN`` (over six such errors) or more off, and all others are
verified by their whole shingle sets, which are sent for those pairs only.

Equal texts are one node. A block of at most ``CROWD`` nodes is joined with itself. In a larger one each
node meets ``HUBS`` hubs only: those whose blocks are the most crowded, so the nodes nearest to what the
crowd has in common. Nodes of crowded blocks that are still in several groups then go one level down: each
is told by how it differs from the foremost hub of its blocks (the shingles that only one of both has).
Texts of a crowd that differ from its hub in unlike places are far apart in this respect, though
nearly as similar as 0.8; texts at 0.8 of which one is below 0.8 to the hub must share differences. Blocks of the
least hashes of these differences are the next level's blocks, and so on for ``LEVELS`` levels. So no
level compares more than max(2 * ``CROWD``, ``HUBS``) pairs for each of its rows, and a node has ``DIFFERENCES``
rows in each level but the first. What is still crowded and in
several groups after the last level is joined in whole: no pair of a common block is left out at that end.

Null texts are empty texts; texts without words are alike only if equal. The document of the smallest
doc_id stays (null comes first); of rows that agree in doc_id and text, one. Empty tables give no
rows; all columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, mix, prepare, shielded, slabs
from .simhash import components, fold, links, shingle_hashes

SHINGLE = 5
SIMILARITY = 0.8
BINS = 128
ROWS = 6
SKETCH = 1024
#: An estimate by sketches this close to the similarity asked for settles nothing.
MARGIN = 0.08
#: Rows of one hub in one part of a join.
PART_ROWS = 2000
#: The same where whole shingle sets are sent.
WHOLE_ROWS = 100
#: Hubs of several parts that are broadcast (12 bytes each).
SENT_HUBS = 100_000
#: Nodes up to which a block is joined with itself (four times as many after the first level); hubs of a larger one.
CROWD = 32
HUBS = 8
#: Levels of blocks: the first of shingles, the others of differences from a hub.
LEVELS = 4
#: Blocks of a difference's least hashes, and hashes in each.
DIFFERENCES = 64
TOGETHER = 3
#: Nodes for which one task at least makes these blocks.
NODES_APART = 16


def _bands(h: np.ndarray) -> np.ndarray:
    """Block keys of a text's distinct shingle hashes."""
    bins = (h >> np.uint64(57)).astype(np.int64)
    order = np.lexsort((h, bins))
    b, v = bins[order], h[order]
    head = np.r_[True, b[1:] != b[:-1]]
    full = b[head]
    least = np.zeros(BINS, np.uint64)
    # an empty bin takes the next full one's value, told apart by its distance
    nxt = np.searchsorted(full, np.arange(BINS)) % len(full)
    least[:] = v[head][nxt] + ((full[nxt] - np.arange(BINS)) % BINS).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    blocks = least[: BINS // ROWS * ROWS].reshape(-1, ROWS)
    key = np.zeros(len(blocks), np.uint64)
    for k in range(ROWS):
        key = mix(key * np.uint64(31) + blocks[:, k])
    return key.view(np.int64)


def _signatures(docs: DataFrame, size: int) -> DataFrame:
    def run(batches):
        for batch, data, offsets in slabs(batches):
            hashes, counts = shingle_hashes(data, offsets, size)
            parts = np.split(mix(hashes), np.cumsum(counts)[:-1])
            sets = [np.unique(p) for p in parts]
            bands = [_bands(p) if len(p) else np.zeros(0, np.int64) for p in sets]
            sizes = pa.array([len(p) for p in sets], pa.int32())
            fp = pa.array(fold(hashes, counts).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, fp, pa.array(bands, pa.list_(pa.int64()))], names=["id", "th", "n", "fp", "bands"])

    return docs.select("_id", "_th", F.col("text").cast("binary").alias("body")).mapInArrow(run, "id bigint, th bigint, n int, fp bigint, bands array<bigint>")


def _sketches(docs: DataFrame, size: int, most: int | None) -> DataFrame:
    """th, sketch: the ``most`` least hashes (None: all) of each text's distinct shingles (top bit
    flipped: sorted as signed)."""

    def run(batches):
        for batch, data, offsets in slabs(batches):
            hashes, counts = shingle_hashes(data, offsets, size)
            parts = np.split(mix(hashes), np.cumsum(counts)[:-1])
            least = [(np.unique(p)[:most] ^ np.uint64(1 << 63)).view(np.int64) for p in parts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(least, pa.list_(pa.int64()))], names=["th", "sketch"])

    return docs.select("_th", F.col("text").cast("binary").alias("body")).mapInArrow(run, "th bigint, sketch array<bigint>")


def _sketched(known: DataFrame, wanted: DataFrame, size: int, most: int | None) -> DataFrame:
    """Sketches of the texts of ``known`` that ``wanted`` (_th, distinct) names."""
    return _sketches(known.join(wanted, "_th", "left_semi").select("_th", "text").dropDuplicates(["_th"]), size, most)


def whole(least: float) -> Column:
    """Whether two whole shingle sets, ``sketch`` and ``hub_sketch``, have that Jaccard similarity: 2 or 0."""
    both = F.size(F.array_intersect("sketch", "hub_sketch"))
    # both >= least * (sizes - both), with ``both`` written once, as Spark computes it as often as it stands
    return F.when(both * F.lit(1 + least) - F.lit(least) * (F.size("sketch") + F.size("hub_sketch")) >= -1e-6, 2).otherwise(0)


def similar(least: float, margin: float) -> Column:
    """2: the shingle sets of two sketches, ``sketch`` and ``hub_sketch``, have that Jaccard similarity;
    0: they have not; 1: texts over ``SKETCH`` whose estimate is within ``margin`` of it."""
    union = F.slice(F.array_sort(F.array_union("sketch", "hub_sketch")), 1, SKETCH)
    found = F.size(F.array_intersect(F.array_intersect("sketch", "hub_sketch"), union)) / F.size(union)
    sampled = F.width_bucket(found, F.lit(least - margin), F.lit(least + margin), F.lit(1)).cast("int")
    return F.when(F.greatest(F.size("sketch"), F.size("hub_sketch")) < SKETCH, whole(least)).otherwise(sampled)


def _verified(edges: DataFrame, sketches: DataFrame, verdict: Column, part_rows: int = PART_ROWS) -> DataFrame:
    """Those of ``edges`` (hub, th) whose ``verdict`` is not 0, with it. A hub's sketch goes to as many
    parts as the number of its edges asks for; only hubs of several parts are joined to their edges by hub."""
    parts = edges.groupBy("hub").agg((F.count("*") / part_rows).cast("int").alias("parts"))
    large = cut(parts.where("parts > 0"))
    hubs = sketches.join(parts, sketches["th"] == parts["hub"]).select("hub", F.col("sketch").alias("hub_sketch"), F.explode(F.sequence(F.lit(0), "parts")).alias("part"))
    part = F.pmod(F.xxhash64("th"), F.coalesce("parts", F.lit(0)) + 1).cast("int")
    # hubs of that many edges are one for each part_rows of them at most; beyond the bound, Spark splits the hot ones
    members = edges.join(F.broadcast(large) if large.count() <= SENT_HUBS else large, "hub", "left").withColumn("part", part).drop("parts")
    return members.join(sketches, "th").join(hubs, ["hub", "part"]).withColumn("verdict", verdict).where("verdict > 0").select("hub", "th", "verdict")


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))).withColumn("_th", F.xxhash64(text))


def _shared(keys: DataFrame) -> DataFrame:
    """``keys`` (k, v, th, n, root) of blocks that hold nodes of different groups, with c, their number of nodes."""
    block = Window.partitionBy("k", "v")
    counted = keys.withColumns({"c": F.count("*").over(block), "_one": F.min("root").over(block), "_other": F.max("root").over(block)})
    return counted.where("_one <> _other").drop("_one", "_other")


def _met(few: DataFrame, least: float) -> DataFrame:
    """hub, th: pairs of nodes in a block of ``few`` that are of different groups and whose sizes allow ``least``."""
    other = few.select("k", "v", *(F.col(c).alias(f"hub_{c}") for c in ("th", "n", "root")))
    sizes = F.least("n", "hub_n") >= F.greatest("n", "hub_n") * F.lit(least)
    met = few.join(other, ["k", "v"]).where((F.col("root") != F.col("hub_root")) & sizes & (F.col("th") > F.col("hub_th")))
    return met.select(F.col("hub_th").alias("hub"), "th").distinct()


def _met_lists(rows: DataFrame, others: DataFrame, least: float, fits) -> DataFrame:
    """hub, th: nodes of ``rows`` and those of ``others`` in their blocks, of different groups and of sizes that allow
    ``least``, if ``fits`` (of the other's th). A block's others, of which there are few, come as one list and a node's lists
    are united before rows are made of them: nodes that share one block often share several."""
    lists = others.groupBy("k", "v").agg(F.collect_list(F.struct("th", "n", "root")).alias("hubs"))
    good = lambda h: (h["root"] != F.col("root")) & fits(h["th"]) & (F.least("n", h["n"]) >= F.greatest("n", h["n"]) * F.lit(least))
    met = rows.join(lists, ["k", "v"]).select("th", F.filter("hubs", good)["th"].alias("hubs")).where(F.size("hubs") > 0)
    return met.groupBy("th").agg(F.array_distinct(F.flatten(F.collect_list("hubs"))).alias("hubs")).select(F.explode("hubs").alias("hub"), "th")


def _met_few(few: DataFrame, least: float) -> DataFrame:
    """As ``_met``, for blocks of a bounded number of nodes: each pair is made once, in however many blocks it meets."""
    return _met_lists(few, few, least, lambda th: th < F.col("th"))


def _met_hubs(crowded: DataFrame, hubs: DataFrame, least: float) -> DataFrame:
    """hub, th: nodes of ``crowded`` and the ``hubs`` of their blocks (at most ``HUBS`` each)."""
    return _met_lists(crowded, hubs, least, lambda th: th != F.col("th"))


def _hubs(crowded: DataFrame) -> DataFrame:
    """k, v, p (how crowded all its blocks are), th, n, root: the foremost node of each of ``HUBS`` parts of each block."""
    part = F.pmod(F.xxhash64("th"), F.lit(HUBS))
    best = crowded.groupBy("k", "v", part.alias("part")).agg(F.max(F.struct("p", "th", "n", "root")).alias("x"))
    return best.select("k", "v", "x.*")


def _differences(homes: DataFrame, sets: DataFrame) -> DataFrame:
    """th, n, root, k, v: block keys of how each node of ``homes`` (th, n, root, home) differs from its home."""
    hub = sets.select(F.col("th").alias("home"), F.col("sketch").alias("hub_sketch"))
    # a home may be that of a third of all nodes: they are dealt to as many parts as their number asks for
    sizes = homes.groupBy("home").agg((F.count("*") / WHOLE_ROWS).cast("int").alias("parts"))
    spread = hub.join(sizes, "home").select("home", "hub_sketch", F.explode(F.sequence(F.lit(0), "parts")).alias("part"))
    dealt = homes.join(sizes, "home").withColumn("part", F.pmod(F.xxhash64("th"), F.col("parts") + 1).cast("int")).drop("parts")
    apart = F.array_union(F.array_except("sketch", "hub_sketch"), F.array_except("hub_sketch", "sketch"))
    rows = dealt.join(sets, "th").join(spread, ["home", "part"]).select("th", "n", "root", "home", apart.alias("apart"))
    seeds = mix(np.arange(1, DIFFERENCES * TOGETHER + 1, dtype=np.uint64))

    def run(batches):
        for batch in batches:
            home = batch.column(3).to_numpy().view(np.uint64)
            at = batch.column(4).offsets.to_numpy()
            flat = batch.column(4).values.to_numpy(zero_copy_only=False).view(np.uint64)
            keys = []
            for i in range(batch.num_rows):
                h = flat[at[i] : at[i + 1]]
                if not len(h):
                    keys.append(np.zeros(0, np.int64))
                    continue
                least = np.full(len(seeds), np.uint64(2**64 - 1))
                for a in range(0, len(h), 4096):  # a long text's differences are many
                    np.minimum(least, mix(h[a : a + 4096, None] ^ seeds[None, :]).min(axis=0), out=least)
                key = np.full(DIFFERENCES, home[i])
                for part in least.reshape(DIFFERENCES, TOGETHER).T:
                    key = mix(key * np.uint64(31) + part)
                keys.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(keys, pa.list_(pa.int64()))], names=["th", "n", "root", "keys"])

    # each node is exploded to many rows: nodes are dealt out evenly, whatever home they have
    conf = homes.sparkSession.conf
    parts = max(1, min(int(conf.get("spark.sql.shuffle.partitions")), homes.count() // NODES_APART))
    return rows.mapInArrow(run, "th bigint, n int, root bigint, keys array<bigint>").repartition(parts).select("th", "n", "root", F.posexplode("keys").alias("k", "v"))


def _settled(judged: DataFrame, known: DataFrame, size: int, least: float) -> DataFrame:
    """hub, th: the pairs of ``judged`` that are similar, those of verdict 1 by their whole shingle sets."""
    sure, unsure = (judged.where(F.col("verdict") == v).select("hub", "th") for v in (2, 1))
    if unsure.isEmpty():
        return sure
    wanted = unsure.select(F.explode(F.array("hub", "th")).alias("_th")).distinct()
    sets = cut(_sketched(known, wanted, size, None))
    return sure.unionByName(cut(_verified(unsure, sets, whole(least), WHOLE_ROWS).select("hub", "th")))


def _by_fingerprint(nodes: DataFrame, known: DataFrame, size: int, least: float, margin: float) -> DataFrame | None:
    """node, root: groups of the nodes (th, n, fp) whose SimHash fingerprints are linked and whose shingle sets are
    as similar as ``least``; None if there are none. Texts without words have no fingerprint here."""
    worded = nodes.where("n > 0").select("th", "fp")
    prints = cut(worded.groupBy("fp").agg(F.min("th").alias("node"), F.count("*").alias("c")))
    near = links(prints.select("node", "fp")).select(F.col("a").alias("hub"), F.col("b").alias("th"))
    same = worded.join(prints.where("c > 1"), "fp").where("th <> node").select(F.col("node").alias("hub"), "th")
    edges = cut(near.unionByName(same))
    if edges.isEmpty():
        return None
    sketches = cut(_sketched(known, edges.select(F.explode(F.array("hub", "th")).alias("_th")).distinct(), size, SKETCH))
    judged = cut(_verified(edges, sketches, similar(least, margin)))
    return components(_settled(judged, known, size, least).select(F.col("hub").alias("a"), F.col("th").alias("b")))


def groups(docs: DataFrame, size: int = SHINGLE, least: float = SIMILARITY, margin: float = MARGIN, crowd: int = CROWD, levels: int = LEVELS, tell: list | None = None) -> DataFrame:
    """_id, _th, root: the group of each row of ``docs``. ``margin``: estimates by sketches this close to
    ``least`` are verified by whole shingle sets. ``tell``: gets
    (rows of blocks, pairs compared) of each level."""
    prepare(docs.sparkSession)
    known = _identified(docs)
    signed = cut(_signatures(known, size))
    nodes = cut(signed.groupBy("th").agg(*(F.first(c).alias(c) for c in ("n", "fp", "bands"))))
    pairs = signed.select(F.col("id").alias("_id"), F.col("th").alias("_th"))
    roots, sketches = _by_fingerprint(nodes, known, size, least, margin), None
    rooted = nodes.withColumn("root", F.col("th")) if roots is None else nodes.join(roots.withColumnRenamed("node", "th"), "th", "left").withColumn("root", F.coalesce("root", "th"))
    keys = rooted.select("th", "n", "root", F.posexplode("bands").alias("k", "v"))
    for level in range(levels + 1):
        open_ = cut(_shared(keys))
        if open_.isEmpty():
            break
        if sketches is None:  # all levels compare nodes of the first one's blocks
            sketches = cut(_sketched(known, open_.select(F.col("th").alias("_th")).distinct(), size, SKETCH))
        most = crowd if level == 0 else 4 * crowd
        few = open_ if level == levels else open_.where(F.col("c") <= most)
        # only the last level's blocks may be of any size
        met = _met(few, least) if level == levels else _met_few(few, least)
        if level < levels:
            place = open_.groupBy("th").agg(F.sum("c").alias("p"))
            crowded = cut(open_.where(F.col("c") > most).join(place, "th"))
            hubs = cut(_hubs(crowded))
            met = met.unionByName(_met_hubs(crowded, hubs, least))
        met = cut(met)
        if tell is not None:
            tell.append((open_.count(), met.count()))
        judged = cut(_verified(met, sketches, similar(least, margin)))
        alike = _settled(judged, known, size, least).select(F.col("hub").alias("a"), F.col("th").alias("b"))
        roots = components(alike if roots is None else alike.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
        if level == levels or crowded.isEmpty():
            break
        now = lambda df: df.drop("root").join(roots.withColumnRenamed("node", "th"), "th", "left").withColumn("root", F.coalesce("root", "th"))
        still = _shared(now(crowded.drop("c")))
        foremost = hubs.groupBy("k", "v").agg(F.max(F.struct("p", "th")).alias("hub"))
        if level == levels - 1:  # the blocks that are left stay as they are
            keys = cut(still.select("th", "n", "root", "k", "v"))
            continue
        homes = cut(still.join(foremost, ["k", "v"]).groupBy("th", "n", "root").agg(F.max("hub")["th"].alias("home")))
        if homes.isEmpty():
            break
        wanted = homes.select(F.explode(F.array("th", "home")).alias("_th")).distinct()
        sets = cut(_sketched(known, wanted, size, None))
        keys = cut(_differences(homes.where("th <> home"), sets))  # read twice
    if roots is None:
        return pairs.withColumn("root", F.col("_th"))
    roots = roots.withColumnRenamed("node", "_th")
    return pairs.join(roots, "_th", "left").select("_id", "_th", F.coalesce("root", "_th").alias("root"))


def keep_one(docs: DataFrame, size: int = SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each group: the one of smallest doc_id."""
    grouped = cut(groups(docs.select("doc_id", "text"), size, least))
    best = grouped.groupBy("root").agg(F.min(F.struct("_id", "_th")).alias("best"), F.count("*").alias("n")).where("n > 1")
    out = grouped.join(best, "root").where((F.col("_id") != F.col("best._id")) | (F.col("_th") != F.col("best._th"))).select("_id", "_th").distinct()
    known = _identified(shielded(docs))
    twice = grouped.groupBy("_id", "_th").agg(F.count("*").alias("n")).where("n > 1")
    if not twice.isEmpty():
        known = known.dropDuplicates(["_id", "_th"])
    return known.join(cut(out), ["_id", "_th"], "left_anti").drop("_id", "_th").toDF(*docs.columns)
