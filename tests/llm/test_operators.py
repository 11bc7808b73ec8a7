import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from linkwright.llm import bpe, chat, decontaminate, lines, lm, media, nearcopies, quality, secrets, simhash, suffix

EXTRA = ["lang", "source", "_body", "_id", "body", "chunk", "th", "fp", "later", "row", "h"]


def sha(b):
    return hashlib.sha256(b).hexdigest()


def rows_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def order(i):
    return -(1 << 63) if i is None else i


def test_suffix_sort():
    rng = np.random.default_rng(1)
    for _ in range(60):
        text = rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 200)).astype(np.uint8)
        raw = text.tobytes()
        assert suffix.sort_suffixes(text, np.arange(len(text)), len(text)).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


def removed(corpus, size=50):
    first = {}
    for i, t in sorted(corpus, key=lambda r: order(r[0])):
        b = (t or "").encode()
        for k in range(len(b) - size + 1):
            first.setdefault(b[k : k + size], order(i))
    out = Counter()
    for i, t in corpus:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if first[b[k : k + size]] < order(i):
                gone[k : k + size] = b"\1" * size
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out[i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))] += 1
    return out


def test_suffix_dedup(docs, none, corpus):
    names = "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    assert rows_of(suffix.remove_repeats(docs), *names) == removed(corpus)
    assert suffix.remove_repeats(none).count() == 0


def test_lm(docs, none, corpus):
    texts = [(t or "").encode().lower().split() for _, t in corpus]
    grams = [Counter(tuple(w[i - n : i]) for n in (1, 2, 3) for i in range(n, len(w) + 1)) for w in texts]
    total, words = sum(grams, Counter()), sum(map(len, texts))
    expected = Counter()
    for (i, _), w, own in zip(corpus, texts, grams):
        score = 0.0
        for k in range(1, len(w) + 1):
            here = min(3, k)
            for n in range(here, 0, -1):
                g = tuple(w[k - n : k])
                if total[g] > own[g]:
                    below = total[g[:-1]] - own[g[:-1]] if n > 1 else words - len(w)
                    score += math.log10(0.4 ** (here - n) * (total[g] - own[g]) / below)
                    break
            else:
                score += math.log10(0.4**here / (1 + words - len(w)))
        expected[i, len(w), round(score, 3)] += 1
    got = Counter((r["doc_id"], r["n_words"], round(r["score"], 3)) for r in lm.score(docs, 3).collect())
    assert sum((got - expected).values()) <= 1  # a third decimal may fall either way
    assert lm.score(none).count() == 0


def test_secrets(docs, none, corpus):
    assign = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
    expected = Counter()
    for i, t in corpus:
        t, found = t or "", []
        found += [(m.start(), 0, m.end(), "assign") for m in assign.finditer(t) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        n = Counter(f[3] for f in found)
        expected[i, n["assign"], n["access"], n["hex"], sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found)).encode())] += 1
    got = secrets.scan(docs)
    assert rows_of(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == expected
    by = {r["doc_id"]: r for r in got.collect()}
    # the password of document 91 stands in another owner's document too, so it is no live secret
    assert by[92]["n_example"] + by[91]["n_example"] >= 2 or by[91]["n_live"] >= 3
    assert secrets.scan(none).count() == 0


def test_secret_ownership(spark):
    """Examples: in three owners' texts, or in five repositories. A copied text counts once."""
    example, own, spread = "Zx9Qw3Er7Ty1Ui5Op2As4Df6", "Kk1Jj2Hh3Gg4Ff5Dd6Ss7Aa8", "Pp0Oo9Ii8Uu7Yy6Tt5Rr4Ee3"
    rows = [(1, f"use {example} here", "a", "en"), (2, f"now {example} here", "b", "en"), (3, f"and {example} here", "c", "en")]
    rows += [(4, f"mine {own} ok", "a", "en"), (5, f"mine {own} ok", "b", "en"), (6, f"mine {own} ok", "c", "en"), (7, f"also {own} ok", "a", "en")]
    rows += [(10 + i, f"{i} {spread} {i}", "a", lang) for i, lang in enumerate(["en", "de", "fr", "es", None])] + [(8, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    got = {r["doc_id"]: (r["spans"], r["n_live"], r["n_example"]) for r in secrets.scan(docs).collect()}
    want = {i: ("", 0, 1) for i in (1, 2, 3, 10, 11, 12, 13, 14)} | {i: ("generic:5:29", 1, 0) for i in (4, 5, 6, 7)} | {8: ("", 0, 0)}
    assert got == want


def test_many_secrets_in_one_text(spark):
    """16,000 keys in one text: positions as by re, in time that follows their number."""
    text = "é " + " ".join(f"{i:032x}" for i in range(16_000)) + " end"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string").selectExpr("doc_id", "text", "'s' AS source", "'l' AS lang")
    began = time.time()
    (got,) = secrets.scan(docs).collect()
    assert got["spans"] == ",".join(f"hex:{m.start()}:{m.end()}" for m in re.finditer("[0-9a-f]{24,}", text)) and got["n_hex"] == 16_000
    assert time.time() - began < 20


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 200])
def test_decontamination(spark, docs, none, corpus, block_bytes):
    text = dict(c for c in corpus if c[0] is not None)
    items = [("b1", " ".join(text[50].split()[22:60])), ("b2", "WORD"), ("b3", None), ("b4", ""), ("a5", text[5].upper())]
    bench = spark.createDataFrame(items, "item_id string, text string")
    find = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    windows = defaultdict(set)
    for item, t in items:
        w = find((t or "").encode().lower())
        for k in range(len(w) - min(10, len(w)) + 1 if w else 0):
            windows[tuple(w[k : k + min(10, len(w))])].add(item)
    expected = Counter()
    for i, t in corpus:
        w, hit, met = find((t or "").encode().lower()), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    met |= windows[tuple(w[k : k + n])]
        expected[i, len(w), len(hit), len(met), sha(",".join(sorted(met)).encode()), bool(hit)] += 1
    names = "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    assert rows_of(decontaminate.report(docs, bench, block_bytes), *names) == expected
    assert any(k[2] for k in expected) and decontaminate.report(none, bench).count() == 0
    assert not decontaminate.report(docs, bench.limit(0)).where("contaminated").count()
    kept = decontaminate.remove_spans(docs, bench, block_bytes)
    assert kept.columns == docs.columns
    clean = {k[0] for k in expected if not k[5]}
    left = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert all(left[i] == t for i, t in text.items() if i in clean and i not in (80, 81)) and 73 not in left and 5 not in left
    assert items[0][1] not in left[50] and left[50].startswith(" ".join(text[50].split()[:20]))


def test_media(docs, none, corpus):
    from linkwright.llm.media import alaw_table, decode_ima, encode, mulaw_table, read_back, to_pcm_wav

    full = docs.select("*", F.coalesce(F.octet_length("text").cast("bigint"), F.lit(0).cast("bigint")).alias("n_bytes"))
    expected = Counter()
    for i, t in corpus:
        b = (t or "").encode()
        p = b + b"\0" * (-len(b) % 64 if b else 64)
        expected[i, len(b), len(p), sha(p), zlib.crc32(p[-64:]), len(encode(b)), sha(encode(b))] += 1
        assert bytes(read_back(encode(b))[2]) == p
    names = "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256"
    made = media.add_media(full)
    assert made.columns == [*full.columns, "media"] and rows_of(media.media_features(made), *names) == expected
    assert media.media_features(media.add_media(full.limit(0))).count() == 0
    # G.711: full scale and silence; a straight ADPCM decoder, one code at a time
    assert mulaw_table()[[0, 0x80, 0xFF, 0x7F]].tolist() == [-32124, 32124, 0, 0] and alaw_table()[[0xD5, 0x55, 0xAA, 0x2A]].tolist() == [8, -8, 32256, -32256]
    blocks = np.random.default_rng(2).integers(0, 256, (5, 64)).astype(np.uint8)
    steps = media.ima_steps()
    for block, got in zip(blocks, decode_ima(blocks)):
        value, index = int(block[:2].view("<i2")[0]), min(int(block[2]), 88)
        want = [value]
        for byte in block[4:].tolist():
            for code in (byte & 15, byte >> 4):
                s = int(steps[index])
                d = (s >> 3) + (s >> 2) * (code & 1) + (s >> 1) * (code >> 1 & 1) + s * (code >> 2 & 1)
                value = max(-32768, min(32767, value - d if code & 8 else value + d))
                index = max(0, min(88, index + (-1, -1, -1, -1, 2, 4, 6, 8)[code & 7]))
                want.append(value)
        assert got.tolist() == want
    assert len(read_back(to_pcm_wav(encode(b"x")))[2]) == 64 * 2 * 2


def fingerprint(t, size):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + size]), 42) for i in range(max(1, len(w) - size + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def roots(items, alike):
    up = {i: i for i in items}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in items:
        for b in items:
            if a < b and alike(a, b):
                up[find(b)] = find(a)
    return {i: find(i) for i in items}


def test_simhash(docs, none, corpus):
    prints = [(i, fingerprint(t, 3)) for i, t in corpus]
    root = roots(sorted({f for _, f in prints}), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    got = Counter((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.cluster(docs).collect())
    assert got == Counter((i, f, least[root[f]]) for i, f in prints)
    assert simhash.cluster(none).count() == 0


@pytest.mark.parametrize("pair_limit", [64, 3])
def test_links_of_large_groups(spark, pair_limit):
    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 1 << 62, 3).tolist()
    prints = {s ^ (1 << int(a)) ^ (1 << int(b)) for s in seeds for a, b in rng.integers(0, 64, (40, 2))} | {int(x) for x in rng.integers(0, 1 << 62, 50)}
    prints = sorted(prints)
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(prints)]
    nodes = spark.createDataFrame(signed, "node bigint, fp bigint")
    for distance in (0, 1, 2):
        want = roots(range(len(prints)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= distance)
        least = defaultdict(lambda: 1 << 62)
        for i, r in want.items():
            least[r] = min(least[r], i)
        got = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes, distance, pair_limit)).collect()}
        assert {i: got.get(i, i) for i in want} == {i: least[r] for i, r in want.items()}


def test_long_matches_and_decoding(spark):
    """One match of a megabyte; null, empty and unknown ids, for a vocabulary of any size."""
    import tiktoken

    ranks, pattern = bpe._public("byte_bpe_multi_50k.tiktoken")
    known = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=bpe.read_ranks(ranks), special_tokens={})
    rng = random.Random(3)
    texts = ["".join(rng.choice("etaoinshrdlu") for _ in range(n)) for n in (100, 513, 5_000, 1_000_000)] + ["ab" * 3_000, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    began = time.time()
    got = {r["doc_id"]: r["tokens"] for r in bpe.encode(docs, ranks, pattern).collect()}
    assert time.time() - began < 60
    # the library itself takes long over the longest one: its digest is checked by decoding
    assert all(got[i] == known.encode_ordinary(t) for i, t in enumerate(texts) if len(t) < 10_000)
    assert b"".join(known.decode_single_token_bytes(x) for x in got[3]).decode() == texts[3]
    tokens = spark.createDataFrame([(1, got[1]), (2, []), (3, None), (4, [65, None, 10**6, 66])], "doc_id bigint, tokens array<int>")
    small = b"\n".join(x for x in ranks.splitlines() if int(x.split()[1]) < 300)
    for lines in (ranks, small):
        pieces = {i: t for t, i in bpe.read_ranks(lines).items()}
        for r in bpe.decode(tokens, lines).collect():
            want = None if r["tokens"] is None else b"".join(pieces.get(x, b"") for x in r["tokens"])
            assert r["decoded"] == want
    words = spark.createDataFrame([(b"",), (b"a",), (b"hello",)], "word binary")
    folded = {bytes(r["word"]): r["ids"] for r in bpe.fold_in_sql(words, ranks).collect()}
    assert folded == {w: known.encode_ordinary(w.decode()) for w in folded}


def test_near_copies(docs, none, corpus):
    kept = nearcopies.keep_one(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    ids = {i for i, _ in got}
    text = dict(corpus)
    assert not ids & {30, 31, 32, 33, 40, 41, 42, 43, 44, 45, 76} and got[None, text[30]] == 1 and 75 in ids
    assert set(range(30)) | set(range(50, 54)) | {90, 91} <= ids and got[80, "twice"] == 1 and got[81, "same id"] == 1
    assert nearcopies.keep_one(none).count() == 0


@pytest.mark.parametrize("sketch", [nearcopies.SKETCH, 64])
def test_near_copy_groups_of_a_diffuse_cloud(spark, sketch, monkeypatch):
    """Variants of one text, few of them alike enough: the groups are those of all similar pairs that
    share a block, also where most are first compared by sketches (SKETCH under the texts' size)."""
    monkeypatch.setattr(nearcopies, "SKETCH", sketch)
    rng = random.Random(5)
    prose = lambda rng, n: " ".join(f"word{rng.randint(0, 900)}" for _ in range(n))
    base = prose(rng, 150).split()
    texts = []
    for i in range(150):
        words = base[:]
        for _ in range(rng.randint(0, 7)):
            words[rng.randrange(150)] = f"new{rng.randint(0, 10**6)}"
        texts.append(" ".join(words))
    texts += [prose(rng, rng.randint(3, 200)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    # a sketch of 64 errs by 0.05: estimates within six times that are verified
    got = {r["_id"]: r["root"] for r in nearcopies.groups(docs, margin=0.3 if sketch == 64 else nearcopies.MARGIN).collect()}

    def hashed(text):
        words = text.lower().split()
        sets = {" ".join(words[i : i + 5]).encode() for i in range(max(1, len(words) - 4))}
        return set(nearcopies.mix(np.array([xxhash.xxh64_intdigest(x, 42) for x in sets], np.uint64)).tolist())

    sets = [hashed(t) for t in texts]
    bands = [set(enumerate(nearcopies._bands(np.array(sorted(x), np.uint64)).tolist())) for x in sets]

    def alike(a, b):
        return bool(bands[a] & bands[b]) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9

    want = roots(range(len(texts)), alike)
    assert len(set(want.values())) > 45  # the cloud holds texts that are like no other
    groups = lambda of: {frozenset(i for i in of if of[i] == r) for r in of.values()}
    assert groups(got) == groups(want)


def test_quality(spark, docs, none, corpus):
    good = [(i, t) for i, t in corpus if i is not None and i < 30]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(1000 + i, 0) for i, _ in good] + [(None, 1), (5, None), (7777, 0)], "doc_id bigint, quality int")
    bad = spark.createDataFrame([(1000 + i, "!! ".join(t.upper().split()) + " ### ###") for i, t in good], "doc_id bigint, text string")
    every = docs.select("doc_id", "text").unionByName(bad)
    learn = ~quality.held_out(F.col("doc_id"))
    fitted = quality.train(every, labels, learn)
    got = {r["doc_id"]: r for r in quality.score(every, fitted).collect()}
    known = [(i, 1) for i, _ in good] + [(1000 + i, 0) for i, _ in good]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in known)
    held = [got[i]["predicted"] == y for i, y in known if got[i]["held_out"]]
    assert len(held) > 5 and sum(held) / len(held) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values()) and None in got
    kept = quality.keep_good(docs, fitted)
    assert kept.columns == docs.columns and kept.count() >= 25 and quality.score(none, fitted).count() == 0
    assert {r["score"] for r in quality.score(docs, quality.train(docs, labels.limit(0))).collect()} == {0.5}


def covered(corpus):
    keyed = [(order(i), i, (t or "").split("\n")) for i, t in corpus]
    seen, out = {}, []
    for key, i, text in sorted(keyed, key=lambda r: r[0]):
        gone = set()
        for p in range(len(text) - 2):
            w = tuple(text[p : p + 3])
            if "".join(w).strip(" ") and seen.setdefault(w, (key, p)) < (key, p):
                gone |= {p, p + 1, p + 2}
        out.append((i, text, gone))
    return out


def test_lines(docs, none, corpus):
    want = Counter()
    for i, text, gone in covered(corpus):
        spans = sum(1 for p in gone if p - 1 not in gone)
        want[i, len(text), len(gone), spans, sha("\n".join(x for p, x in enumerate(text) if p not in gone).encode())] += 1
    assert rows_of(lines.report(docs), "doc_id", "n_lines", "n_removed", "n_spans", "kept_sha256") == want
    assert any(k[2] for k in want) and lines.report(none).count() == 0
    kept = lines.remove_repeats(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes and kept.count() == len(corpus)


def test_bpe(docs, none, corpus):
    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    ranks, pattern = bpe._public("byte_bpe_multi_50k.tiktoken")
    assert pattern == public.PATTERN
    plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(ranks), special_tokens={})
    want = Counter()
    for i, t in corpus:
        ids = plain.encode_ordinary(t or "")
        want[i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())] += 1
    assert rows_of(bpe.encode(docs, ranks, pattern, digests=True), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    back = bpe.decode(bpe.encode(docs, ranks, pattern), ranks)
    assert Counter((r["doc_id"], bytes(r["decoded"])) for r in back.collect()) == Counter((i, (t or "").encode()) for i, t in corpus)
    assert bpe.encode(none, ranks, pattern).count() == 0


def test_bpe_in_sql(spark, corpus):
    tiktoken = pytest.importorskip("tiktoken")
    ranks, pattern = bpe._public("byte_bpe_multi_50k.tiktoken")
    plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(ranks), special_tokens={})
    words = sorted({w for i, t in corpus if i != 90 for w in (t or "").split()})[:150] + ["a", " "]
    df = spark.createDataFrame([(w.encode(),) for w in words], "word binary")
    got = {bytes(r["word"]).decode(): r["ids"] for r in bpe.fold_in_sql(df, ranks).collect()}
    assert got == {w: plain._core_bpe.encode_single_piece(w.encode()) for w in words}


def test_chat(spark):
    turns = [(1, 0, "user", "a"), (1, 1, "user", None), (1, 2, "assistant", "<|im_end|> <\\|x"), (1, 3, "assistant", "<<|\\"), (1, 4, None, ""), (2, None, "assistant", "only"), (None, 1, "us\ner\\", "x<"), (3, 5, "user", "t" * 70_000), (3, 5, "user", "t" * 70_000), (4, 0, "assistant", chat.PROBE)]
    df = spark.createDataFrame([(*t, "x", "y") for t in turns], "conv_id bigint, turn bigint, role string, text string, turns string, segments string")
    got = {r["conv_id"]: r for r in chat.report(df).collect()}
    made = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}
    for conv in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (order(t[1]), t[2] or "", t[3] or ""))
        every = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in own)
        loss = "".join(x or "" for _, _, r, x in own if r == "assistant")
        assert (got[conv]["n_turns"], got[conv]["turns_sha256"], got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(own), sha(every.encode()), len(loss), sha(loss.encode()))
        assert got[conv]["formatted_chars"] == len(made[conv]["formatted"])
    assert made[1]["formatted"].count(chat.START) == made[1]["formatted"].count(chat.END) == 3  # merged by role
    assert chat.report(df.limit(0)).count() == 0


def test_media_features_by_plain_steps(docs, corpus):
    """The feature string of every text, from the stored forms, sample by sample."""
    from linkwright.llm.media import IMA_ADPCM, add_media, alaw_table, decode_ima, encode, mulaw_table, read_back, stored, to_pcm_wav

    full = docs.select("doc_id", F.coalesce(F.octet_length("text").cast("bigint"), F.lit(0).cast("bigint")).alias("n_bytes"), "text")
    expected = Counter()
    for i, t in corpus:
        p = list((t or "").encode())
        p += [0] * (-len(p) % 64 if p else 64)
        mu, a = [int(mulaw_table()[x]) for x in p], [int(alaw_table()[x]) for x in p]
        ima = [int(x) for k in range(0, len(p), 64) for x in decode_ima(np.array([p[k : k + 64]], np.uint8))[0]]
        wide = []
        for x, y in zip(mu, mu[1:] + mu[-1:]):
            wide += [x, (x + y) >> 1]
        crc = zlib.crc32(b"".join(x.to_bytes(2, "little", signed=True) for x in wide))
        rms = [round(math.sqrt(sum(x * x for x in s) / len(s)), 3) for s in (mu, a, ima)]
        crossings = sum((x < 0) != (y < 0) for x, y in zip(mu, mu[1:]))
        expected[i, f"mulaw_rms={rms[0]};alaw_rms={rms[1]};adpcm_rms={rms[2]};crossings={crossings};pcm_rate=16000;pcm_crc32={crc}"] += 1
    assert rows_of(media.media_features(add_media(full)), "doc_id", "feature") == expected
    kept = stored(add_media(full)).where("doc_id = 91").first()
    assert bytes(kept["pcm"]) == to_pcm_wav(bytes(kept["media"])) and read_back(bytes(kept["adpcm"]))[0] == IMA_ADPCM
    assert bytes(read_back(bytes(kept["alaw"]))[2]) == bytes(read_back(encode(kept["text"].encode()))[2])
