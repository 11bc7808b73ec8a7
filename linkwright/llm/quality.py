"""Quality classifier: Bradley-Terry pairwise ranking over features of the text alone.

From labelled rows, pairs (better, worse) are formed; weights minimise the logistic loss of the
feature differences, so that the better one's score exceeds the worse one's. A document's raw score
is threshold-centred: the cut is the quantile of the labelled scores at which most labels are right,
and score = 1 / (1 + exp(-(raw - cut) * slope)).

The fit takes at most ``FIT_ROWS`` labelled rows (those of smallest hash of the id), a documented
bound; scoring reads every whole text. Null texts are empty texts and get a score like any other.
Labels that are null, that contradict each other for one id, or whose id has no document are not
learnt from. Without both kinds of labels every score is 0.5. Extra columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, prepare, shielded, slabs, span_hashes, table

FIT_ROWS = 12_000
PAIRS_EACH = 8

NAMES = ("log_bytes", "log_words", "upper", "digit", "symbol", "space", "high", "line", "mean_word", "long_word", "distinct", "repeat", "rich_pair", "symbol_word", "stop", "comma", "bang", "pipe", "distinct_line", "hash", "short_word", "upper_word", "digit_word")

_UPPER = np.zeros(256, bool); _UPPER[65:91] = True  # noqa: E702
_LOWERC = np.zeros(256, bool); _LOWERC[97:123] = True  # noqa: E702
_DIGIT = np.zeros(256, bool); _DIGIT[48:58] = True  # noqa: E702
_SPACE = np.zeros(256, bool); _SPACE[[32, *range(9, 14)]] = True  # noqa: E702
_HIGH = np.zeros(256, bool); _HIGH[128:] = True  # noqa: E702
_SYMBOL = ~(_UPPER | _LOWERC | _DIGIT | _SPACE | _HIGH)
_COMMON = _SYMBOL & np.isin(np.arange(256), [ord(c) for c in ".,;:'\"-?()"])
_ODD = _SYMBOL & ~_COMMON


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets]).astype(float)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of numbers for each text."""
    n_rows = len(offsets) - 1
    size = np.maximum(np.diff(offsets).astype(float), 1)
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = _SPACE[data]
    first, last = ~gap[1:-1] & gap[:-2], ~gap[1:-1] & gap[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = ~gap[1:-1][inner]
    last[inner - 1] = ~gap[1:-1][inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    bounds = np.searchsorted(row, np.arange(n_rows + 1))
    words = np.maximum(np.diff(bounds).astype(float), 1)
    length = ends - starts
    h = span_hashes(data, starts, ends)
    odd = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_ODD[data], out=odd[1:])
    up = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_UPPER[data], out=up[1:])
    dig = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_DIGIT[data], out=dig[1:])

    def over_words(flags):
        return _per_row(flags, bounds) / words

    def distinct(keys, rows, counts):
        order = np.lexsort((keys, rows))
        k, r = keys[order], rows[order]
        new = np.r_[True, (k[1:] != k[:-1]) | (r[1:] != r[:-1])] if len(k) else np.zeros(0, bool)
        return np.bincount(r[new], minlength=n_rows) / counts

    # a word may be told by its row as well as its hash, so equal neighbours are repeats
    again = np.r_[False, (h[1:] == h[:-1]) & (row[1:] == row[:-1])] if len(h) else np.zeros(0, bool)
    pair = mix(h[:-1] * np.uint64(3) + h[1:]) if len(h) else h
    pair_row = row[:-1] if len(h) else row
    newline = data == 10
    lines = _per_row(newline, offsets) + 1
    cuts = np.unique(np.r_[offsets[:-1], np.flatnonzero(newline) + 1, len(data)])
    line_row = np.searchsorted(offsets, cuts[:-1], side="right") - 1
    line_hash = span_hashes(data, cuts[:-1], cuts[1:]) if len(cuts) > 1 else np.zeros(0, np.uint64)
    columns = [
        np.log1p(np.diff(offsets)), np.log(words), _per_row(_UPPER[data], offsets) / size, _per_row(_DIGIT[data], offsets) / size, _per_row(_ODD[data], offsets) / size, _per_row(_SPACE[data], offsets) / size,
        _per_row(_HIGH[data], offsets) / size, np.log(lines / words + 1), _per_row(length, bounds) / words, over_words(length > 14), distinct(h, row, words), over_words(again), distinct(pair, pair_row, words),
        over_words(odd[ends] - odd[starts] > 0), over_words(length <= 3), _per_row(data == 44, offsets) / words, _per_row(data == 33, offsets) / size, _per_row(data == 124, offsets) / words,
        distinct(line_hash, line_row, np.maximum(np.bincount(line_row, minlength=n_rows), 1)), _per_row((data == 35) | (data == 36) | (data == 37) | (data == 38) | (data == 42), offsets) / words,
        over_words(length == 1), over_words((up[ends] - up[starts] > 1) & (up[ends] - up[starts] >= length * 0.6)), over_words(dig[ends] - dig[starts] > 0),
    ]
    return np.stack(columns, axis=1)


def feature_rows(docs: DataFrame) -> DataFrame:
    """doc_id, x (the features)."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch, data, offsets in slabs(batches):
            x = features(data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("body")).mapInArrow(run, "doc_id bigint, x array<double>")


def fit(x: np.ndarray, y: np.ndarray, pairs_each: int = PAIRS_EACH, l2: float = 1e-3, seed: int = 7) -> dict:
    """Weights, centre, scale, cut and slope from features and labels (the model)."""
    width = x.shape[1] if x.ndim == 2 and x.shape[0] else len(NAMES)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return {"w": np.zeros(width), "mean": np.zeros(width), "std": np.ones(width), "cut": 0.0, "slope": 1.0}
    mean, std = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.clip((x - mean) / std, -6, 6)
    rng = np.random.default_rng(seed)
    n = pairs_each * max(len(good), len(bad))
    # every row takes part: the rarer side is gone through again and again
    left = np.concatenate([rng.permutation(good) for _ in range(-(-n // len(good)))])[:n]
    right = np.concatenate([rng.permutation(bad) for _ in range(-(-n // len(bad)))])[:n]
    d = z[left] - z[right]
    w = np.zeros(width)
    for _ in range(25):  # Newton steps on the mean logistic loss
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        gradient = -(d * p[:, None]).mean(axis=0) + l2 * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + l2 * np.eye(width)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    cuts = np.quantile(s, np.linspace(0, 1, 401))
    mid = (cuts[:-1] + cuts[1:]) / 2
    right_share = ((s[None, :] >= mid[:, None]) == (y[None, :] == 1)).mean(axis=1)
    best = np.flatnonzero(right_share == right_share.max())
    cut = float(mid[best[len(best) // 2]])
    return {"w": w, "mean": mean, "std": std, "cut": cut, "slope": 1.0}


def apply(model: dict, x: np.ndarray) -> np.ndarray:
    z = np.clip((x - model["mean"]) / model["std"], -6, 6)
    return 1 / (1 + np.exp(-np.clip((z @ model["w"] - model["cut"]) * model["slope"], -30, 30)))


def train(docs: DataFrame, labels: DataFrame, learn: F.Column | None = None, fit_rows: int = FIT_ROWS) -> dict:
    """A model from a bounded sample of ``labels`` (doc_id, quality) for which ``learn`` holds."""
    known = labels.where("doc_id is not null and quality in (0, 1)")
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("z")).where("y = z").drop("z")
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    # at most fit_rows ids: small enough to broadcast whatever the corpus holds
    texts = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    rows = feature_rows(texts).join(F.broadcast(sample), "doc_id").orderBy("doc_id").collect()
    return fit(np.array([r["x"] for r in rows], float), np.array([r["y"] for r in rows], int))


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted: a row for each row of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)

    def run(batches):
        for batch, data, offsets in slabs(batches):
            s = np.round(apply(model, features(data, offsets)), 9)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    doc_id = F.col("doc_id").cast("bigint")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(held_out(doc_id), F.lit(False)).alias("held_out"), F.col("text").cast("binary").alias("body"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``, unchanged."""
    prepare(docs.sparkSession)
    inner = shielded(docs)
    columns = inner.columns

    def run(batches):
        for batch, data, offsets in slabs(batches, "_body"):
            yield batch.select(columns).filter(pa.array(apply(model, features(data, offsets)) >= threshold))

    return inner.withColumn("_body", F.col("text").cast("binary")).mapInArrow(run, inner.schema).toDF(*docs.columns)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score(docs, train(docs, labels, ~held_out(F.col("doc_id").cast("bigint"))))
