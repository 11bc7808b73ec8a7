"""What the corpus operators share: slabs of bytes, packed exchanges, cut lineage, salted joins."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at once (a longer text is one slab).
SLAB_BYTES = 2 << 20
#: Rows that Spark packs into one Arrow batch; texts may be long.
ARROW_ROWS = 512
#: Parts into which the rows of one key are dealt in a salted join.
SALTS = 16

_scratch: dict[str, str] = {}


def prepare(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Keep Arrow batches of whole texts small."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def scratch(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a folder of our own only where it names none."""
    named = spark.conf.get("spark.checkpoint.dir", "") or ""
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        _scratch[app] = "file://" + tempfile.mkdtemp(prefix="linkwright-")
    return _scratch[app]


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: its lineage ends there."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/linkwright/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shielded(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but doc_id, text and n_chars renamed by place, so that an operator that
    keeps every column can add its own under any name; ``toDF(*docs.columns)`` names them back."""
    return docs.toDF(*[c if c in ("doc_id", "text", "n_chars") else f"_kept{i}" for i, c in enumerate(docs.columns)])


def slabs(batches: Iterator[pa.RecordBatch], column: str = "body", limit: int = SLAB_BYTES):
    """(batch slice, bytes, offsets) for runs of rows whose binary ``column`` has at most
    ``limit`` bytes together; null is empty. A row over the limit comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        if col.null_count:
            col = col.fill_null(b"")
        wide = pa.types.is_large_binary(col.type)
        _, off, data = col.buffers()
        offs = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        i = 0
        while i < len(col):
            j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
            j = min(max(j, i + 1), len(col))
            yield batch.slice(i, j - i), raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            i = j


def release() -> None:
    """Give freed memory back to the system: a worker's next task starts small."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    have = 1
    while have < n:
        step = np.uint64(pow(base, have, 1 << 64))
        take = min(have, n - have)
        out[have : have + take] = out[:take] * step
        have += take
    return out[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), so that high and low bits are both usable."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def rolling(data: np.ndarray, k: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of each k-byte string of ``data`` by repeated doubling."""
    if len(data) < k:
        return np.zeros(0, np.uint64)
    one = data.astype(np.uint64) + np.uint64(1)
    cur, size = one, 1
    for bit in bin(k)[3:]:
        cur = cur[:-size] * np.uint64(pow(base, size, 1 << 64)) + cur[size:]
        size *= 2
        if bit == "1":
            cur = cur[:-1] * np.uint64(base) + one[size:]
            size += 1
    return cur


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of each data[start:end], independent of where it stands."""
    n = len(data)
    inverse = pow(base, -1, 1 << 64)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, n), out=prefix[1:])
    back = powers(inverse, n + 1)
    return mix((prefix[ends] - prefix[starts]) * back[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def salted_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Equi-join whose big side may hold a third of its rows under one key: each key of the
    small side is repeated ``salts`` times, the big side's rows are dealt among them."""
    dealt = big.withColumn("_salt", F.pmod(F.xxhash64(*[c for c, t in big.dtypes if t in ("bigint", "int", "string")]), F.lit(salts)).cast("int"))
    spread = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(spread, [key, "_salt"], how).drop("_salt")
