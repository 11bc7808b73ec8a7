"""Media columns: telephony audio (G.711 mu-law and A-law, IMA ADPCM) in binary columns.

``encode`` packs bytes as the samples of a mono WAV of one of the formats; ``read_back`` parses such a file
again and returns its samples; ``stored`` keeps all of them and the resampled PCM as columns. Companded samples are expanded by 256-entry tables computed from the
published rules; ADPCM blocks are decoded step by step with numpy across all blocks at once;
``resample`` doubles 8 kHz to 16 kHz by linear interpolation in integers.

A null text is an empty one: its payload is 64 zero bytes. Texts of any length are handled one
by one or in slabs; equal texts give equal values. Empty tables give no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import prepare, release, slabs, table

#: Bytes of stored files that a worker handles at once: samples and sums of squares take up to 50 times as much.
RUN_BYTES = 256 << 10
#: Rows of one Arrow batch: a row's five forms together are eight times its text.
BATCH_ROWS = 64
BLOCK = 64
RATE = 8000
MULAW, ALAW, IMA_ADPCM, PCM = 7, 6, 0x11, 1


def mulaw_table() -> np.ndarray:
    """G.711 mu-law: bytes are stored inverted; sign, 3 bits of exponent, 4 of mantissa, bias 132."""
    b = ~np.arange(256, dtype=np.int64) & 0xFF
    size = (((b & 15) << 3) + 132 << ((b >> 4) & 7)) - 132
    return np.where(b & 128, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    """G.711 A-law: even bits are stored inverted; the lowest exponent is linear."""
    b = np.arange(256, dtype=np.int64) ^ 0x55
    e, m = (b >> 4) & 7, (b & 15) << 4
    size = np.where(e == 0, m + 8, (m + 264) << np.maximum(e - 1, 0))
    return np.where(b & 128, size, -size).astype(np.int16)


def ima_steps() -> np.ndarray:
    """The 89 step sizes of IMA ADPCM."""
    # fixed values: the standard's table, in its order
    steps = [
        7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494,
        544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487,
        12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
    ]
    return np.array(steps, np.int32)


#: How a 4-bit code moves the step index (fixed values of the standard).
_MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int8)
_MU, _A, _STEPS = mulaw_table(), alaw_table(), ima_steps()
# signed difference for each (step index, code): step/8 + step/4, /2, /1 as the code's bits say
_CODE = np.arange(16)
_DELTA = ((_STEPS[:, None] >> 3) + (_STEPS[:, None] >> 2) * (_CODE & 1) + (_STEPS[:, None] >> 1) * (_CODE >> 1 & 1) + _STEPS[:, None] * (_CODE >> 2 & 1)) * np.where(_CODE & 8, -1, 1)
_DELTA = _DELTA.astype(np.int32).ravel()
_NEXT = np.clip(np.arange(89)[:, None] + _MOVES[None, :], 0, 88).astype(np.int16).ravel()


def decode_ima(blocks: np.ndarray) -> np.ndarray:
    """int16 samples of mono IMA ADPCM blocks (n, size): a 4-byte header (first sample, step
    index, 0), then two codes a byte, low one first. All blocks go one step at a time together."""
    n, size = blocks.shape
    out = np.empty((1 + 2 * (size - 4), n), np.int16)
    value = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2], 88).astype(np.int16)
    out[0] = value
    codes = np.ascontiguousarray(blocks[:, 4:].T)
    for k in range(2 * (size - 4)):
        at = index * np.int16(16) + (codes[k >> 1] >> 4 if k & 1 else codes[k >> 1] & 15)
        value += _DELTA[at]
        np.clip(value, -32768, 32767, out=value)
        index = _NEXT[at]
        out[k + 1] = value
    return out.T


def resample(pcm: np.ndarray) -> np.ndarray:
    """Twice the rate: each sample, then the mean (rounded down) of it and the next one."""
    out = np.empty(2 * len(pcm), np.int16)
    out[::2] = pcm
    nxt = np.r_[pcm[1:], pcm[-1:]] if len(pcm) else pcm
    out[1::2] = (pcm.astype(np.int32) + nxt) >> 1
    return out


def wav(samples: bytes, kind: int, rate: int = RATE, bits: int = 8) -> bytes:
    """A mono WAV file of raw ``samples``."""
    fmt = struct.pack("<HHIIHHH", kind, 1, rate, rate * bits // 8, bits // 8, bits, 0)
    fact = struct.pack("<4sII", b"fact", 4, len(samples) * 8 // bits)
    body = b"WAVE" + struct.pack("<4sI", b"fmt ", len(fmt)) + fmt + fact + struct.pack("<4sI", b"data", len(samples)) + samples + b"\0" * (len(samples) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_back(media: bytes) -> tuple[int, int, memoryview]:
    """Format, rate and samples of a WAV file."""
    view, at, kind, rate = memoryview(media), 12, 0, 0
    if bytes(view[:4]) != b"RIFF" or bytes(view[8:12]) != b"WAVE":
        raise ValueError("not a WAV file")
    while at + 8 <= len(view):
        name, size = struct.unpack_from("<4sI", view, at)
        if name == b"fmt ":
            kind, _, rate = struct.unpack_from("<HHI", view, at + 8)
        if name == b"data":
            return kind, rate, view[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no samples")


def encode(body: bytes, kind: int = MULAW) -> bytes:
    """``body`` and zeros up to a positive multiple of 64, as samples of ``kind`` (ADPCM: blocks of 64)."""
    return wav(body + b"\0" * (-len(body) % BLOCK if body else BLOCK), kind, bits=4 if kind == IMA_ADPCM else 8)


def decode(samples, kind: int) -> np.ndarray:
    """PCM of stored samples of any of the three formats."""
    raw = np.frombuffer(samples, np.uint8)
    if kind == MULAW:
        return _MU[raw]
    if kind == ALAW:
        return _A[raw]
    if kind == IMA_ADPCM:
        return decode_ima(raw.reshape(-1, BLOCK)).ravel()
    raise ValueError(f"unknown format {kind}")


def to_pcm_wav(media: bytes) -> bytes:
    """The operator's stored form for training: any of the formats as 16 kHz PCM."""
    kind, rate, samples = read_back(media)
    return wav(resample(decode(samples, kind)).tobytes(), PCM, 2 * rate, 16)


def _with_binary(docs: DataFrame, source: str, made: dict) -> DataFrame:
    """``docs`` with binary columns (in place of any of their names): each of ``made`` is a function of the bytes of ``source``."""
    prepare(docs.sparkSession, BATCH_ROWS)
    kept = docs.drop(*made)
    columns = kept.columns
    schema = StructType([*kept.schema.fields, *(StructField(c, BinaryType()) for c in made)])
    body = "_" * (1 + max(map(len, docs.columns))) + "body"  # longer than any column's name

    def run(batches):
        for batch, data, offsets in slabs(batches, body, RUN_BYTES):
            raw = data.tobytes()
            parts = [raw[a:b] for a, b in zip(offsets, offsets[1:])]
            files = [pa.array([f(x) for x in parts], pa.binary()) for f in made.values()]
            yield pa.RecordBatch.from_arrays([*batch.select(columns).columns, *files], names=[*columns, *made])
        release()

    return docs.withColumn(body, F.col(source).cast("binary")).select(*columns, body).mapInArrow(run, schema)


def add_media(docs: DataFrame, text: str = "text", media: str = "media", kind: int = MULAW) -> DataFrame:
    """``docs`` with a binary column ``media`` (in place of any of that name) of WAV files of ``kind``."""
    return _with_binary(docs, text, {media: lambda x: encode(x, kind)})


def add_pcm(docs: DataFrame, media: str = "media", pcm: str = "pcm") -> DataFrame:
    """``docs`` with a binary column ``pcm``: the files of ``media``, expanded and resampled to 16 kHz PCM."""
    return _with_binary(docs, media, {pcm: to_pcm_wav})


def _again(kind: int):
    """The samples of a file, stored as samples of another format."""
    return lambda media: encode(bytes(read_back(media)[2]), kind)


#: Further stored forms of a file ``media``, by column.
FORMS = {"alaw": _again(ALAW), "adpcm": _again(IMA_ADPCM), "pcm": to_pcm_wav}


def stored(docs: DataFrame, media: str = "media") -> DataFrame:
    """``docs`` with the payload of ``media`` as A-law and ADPCM files too, and with ``media`` as 16 kHz PCM (``pcm``)."""
    return _with_binary(docs, media, FORMS)


def add_forms(docs: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """``stored(add_media(docs))``, all columns made by one worker."""
    return _with_binary(docs, text, {media: encode, **{c: lambda x, f=f: f(encode(x)) for c, f in FORMS.items()}})


def _power(pcm: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of squares for each run of samples."""
    total = np.zeros(len(pcm) + 1, np.int64)
    np.cumsum(pcm.astype(np.int64) ** 2, out=total[1:])
    return np.diff(total[bounds])


def media_features(df: DataFrame, media: str = "media", alaw: str = "alaw", adpcm: str = "adpcm", pcm: str = "pcm", keep: tuple[str, ...] = ("doc_id", "n_bytes")) -> DataFrame:
    """Digests of the stored file ``media`` and of its samples, and a feature string: root mean squares of the
    samples of ``media``, ``alaw`` and ``adpcm`` (the same payload stored in the three formats), zero
    crossings, and rate and CRC-32 of the samples stored in ``pcm``. Forms that are not there are stored first."""
    prepare(df.sparkSession, BATCH_ROWS)
    if missing := {c: FORMS[n] for c, n in ((alaw, "alaw"), (adpcm, "adpcm"), (pcm, "pcm")) if c not in df.columns}:
        df = _with_binary(df, media, missing)
    schema = ", ".join([f"{c} bigint" for c in keep] + ["payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"])

    def run(batches):
        for batch, data, offsets in slabs(batches, "_body", RUN_BYTES):
            raw = data.tobytes()
            files = [raw[a:b] for a, b in zip(offsets, offsets[1:])]
            parts = [read_back(f) for f in files]
            others = [[read_back(f) for f in batch.column(batch.schema.get_field_index(c)).to_pylist()] for c in ("_alaw", "_adpcm", "_pcm")]
            powers, bounds = [], []
            for stored in (parts, *others[:2]):
                samples = decode(b"".join(p[2] for p in stored), stored[0][0])
                per = len(samples) / max(1, sum(len(p[2]) for p in stored))  # samples a byte: blocks are whole
                cuts = (np.r_[0, np.cumsum([len(p[2]) for p in stored])] * per).round().astype(np.int64)
                powers.append(_power(samples, cuts) / np.diff(cuts))
                bounds.append((samples, cuts))
            mu, cuts = bounds[0]
            sign = np.zeros(len(mu) + 1, np.int64)
            np.cumsum(np.r_[False, (mu[1:] < 0) != (mu[:-1] < 0)], out=sign[1:])
            rows = []
            for i, (f, (_, _, samples), (_, rate, wide)) in enumerate(zip(files, parts, others[2])):
                crossings = int(sign[cuts[i + 1]] - sign[cuts[i] + 1])
                rms = [round(float(np.sqrt(p[i])), 3) for p in powers]
                said = f"mulaw_rms={rms[0]};alaw_rms={rms[1]};adpcm_rms={rms[2]};crossings={crossings};pcm_rate={rate};pcm_crc32={zlib.crc32(wide)}"
                rows.append((len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-BLOCK:]), len(f), hashlib.sha256(f).hexdigest(), said))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            yield pa.RecordBatch.from_arrays([*batch.select(list(keep)).columns, *(pa.array(list(c), k) for c, k in zip(zip(*rows), kinds))], names=[*keep, *names])
        release()

    columns = [F.col(c).alias(n) for c, n in ((media, "_body"), (alaw, "_alaw"), (adpcm, "_adpcm"), (pcm, "_pcm"))]
    return df.select(*keep, *columns).mapInArrow(run, schema)


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.octet_length("text").cast("bigint"), F.lit(0).cast("bigint")).alias("n_bytes"), "text")
    return media_features(add_forms(docs))
