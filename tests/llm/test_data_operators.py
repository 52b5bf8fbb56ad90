"""Mixing, search, sharding, the language model and token files against brute force, and on awkward tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import hmm, mixing, neighbours, sharding, token_files
from corpusloom.session import scratch_dir

DOCS = "doc_id long, text string, source string, slot string, shard string, block string, token string, rate string"


def table(spark, rows):
    return spark.createDataFrame([(*r, *["a"] * (3 - len(r)), "x", "x", "x", "x", "x") for r in rows], DOCS)


ODD = [(1, None), (1, ""), (None, "a b"), (None, "a b"), (2, "one two"), (2, "one two"), (3, "x " * 30_000)]


# ---- mixing ----


def poisson_copies(rate, key):
    parts = max(1, math.ceil(rate / mixing.PART))
    total = 0
    for i in range(1, parts + 1):
        u = int(hashlib.md5(f"{key}:{i}".encode()).hexdigest()[:13], 16) / (1 << 52)
        p = c = math.exp(-rate / parts)
        k = 0
        while c <= u:
            k += 1
            p *= rate / parts / k
            c += p
        total += k
    return total


@pytest.mark.parametrize("weights", [None, {"a": 3.0, "b": 0.0}, {"c": 4000.0}])
def test_copies_equal_brute_force(spark, weights):
    rng = random.Random(2)
    rows = [(i, "w" * rng.randrange(1, 9), rng.choice("aaaaabbc")) for i in range(300)]
    rows += [(900, None, "a"), (901, "", "d"), (None, "zz", None), (3, "w", "a"), (3, "w", "a")]
    docs = table(spark, rows)
    volumes = Counter()
    for _, t, s in rows:
        volumes[s] += len(t or "")
    weight = {s: (weights or {}).get(s, 1.0) if volumes[s] else 0.0 for s in volumes}
    rate = {s: sum(volumes.values()) * weight[s] / sum(weight.values()) / volumes[s] if volumes[s] else 0.0 for s in volumes}
    out = mixing.poisson_mix(docs, weights).collect()
    want = Counter()
    for i, _, s in rows:
        n = poisson_copies(rate[s], f"{mixing.SEED}:{'' if i is None else i}")
        want.update({(i, c): 1 for c in range(1, n + 1)})
    assert Counter((r.doc_id, r._copy) for r in out) == want
    assert [r._order for r in out] == sorted(r._order for r in out)
    assert mixing.poisson_mix(docs).columns == [*docs.columns, "_copy", "_order"]


def test_mixture_reaches_its_weights(spark):
    rows = [(i, "w" * 10, "a" if i % 10 else "b") for i in range(4000)]
    out = mixing.poisson_mix(table(spark, rows), {"a": 1, "b": 3}, total=80_000).groupBy("source").count().collect()
    n = {r.source: r["count"] for r in out}
    assert abs(n["a"] - 2000) < 200 and abs(n["b"] - 6000) < 400
    assert mixing.poisson_mix(table(spark, [])).count() == 0


# ---- search ----


def cosines(rows):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    return good


def brute_nearest(rows, is_query, top=5):
    good, out = cosines(rows), {}
    for i, v in good:
        if is_query(i):
            near = sorted(((-float((v * w).sum() / (np.linalg.norm(v) * np.linalg.norm(w))), j) for j, w in good if j != i))
            out[i] = [(j, -s) for s, j in near[:top]]
    return out


def test_neighbours_of_a_small_table_with_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    rows += [(i, rows[3][1]) for i in range(100, 140)]
    rows += [(200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [1.0, None] + [0.0] * 6), (None, [1.0] * 8), (204, []), (205, [1.0]), (5, rows[5][1])]
    vectors = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, part string, rank int")
    out = neighbours.nearest(vectors, F.col("vec_id") % 10 == 0, recall=1.0).collect()
    want = brute_nearest([r for r in rows if r[1] is None or len(r[1]) != 1], lambda i: i % 10 == 0)
    found = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == set(want)
    hits = sum(len({j for j, _ in found[q]} & {j for j, _ in want[q]}) for q in want) / sum(map(len, want.values()))
    assert hits >= 0.9
    for q, near in found.items():
        scores = [s for _, s in near]
        assert scores == sorted(scores, reverse=True) and q not in [j for j, _ in near]
    assert [j for j, _ in found[100]] == [3, 101, 102, 103, 104]
    assert neighbours.nearest(vectors.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("name", ["sf0.01", "sf0.1"])
def test_recall_on_the_embeddings(spark, name):
    vectors = spark.read.parquet(f"/root/testdata/{name}/embeddings.parquet")
    out = neighbours.nearest(vectors, F.col("vec_id") % 50 == 0).collect()
    rows = vectors.toPandas()
    x = np.stack(rows.embedding).astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T
    np.fill_diagonal(near, -2)
    ids, hits, all_hits = rows.vec_id.to_numpy(), 0, 0
    found = {(r.query_id, r.vec_id) for r in out}
    for q in np.flatnonzero(ids % 50 == 0):
        best = ids[np.lexsort((ids, -near[q]))[:5]]
        hits += sum((int(ids[q]), int(j)) in found for j in best)
        all_hits += 5
    assert len(out) == all_hits and hits / all_hits >= 0.9


# ---- sharding ----


def test_shards_follow_the_key_law(spark):
    rows = [(i, "é" * (i % 7), "s") for i in range(6000)]
    tree = sharding.HashTree.even(2, 3, 4)
    out = sharding.shard(table(spark, [*rows, *ODD]), tree).collect()
    assert len(out) == 6000 + len(ODD) and {r.law for r in out} == {"key"}
    for r in out:
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
    moved = np.mean([r.grown_shard == 24 for r in out])
    assert abs(moved - 1 / 25) < 0.01
    sizes = Counter(r.shard for r in out)
    assert all(abs(n - 250) < 75 for n in sizes.values())
    for s, n in sizes.items():
        assert sorted(r.slot for r in out if r.shard == s) == list(range(n))
    texts = {**dict((i, t) for i, t, _ in rows)}
    for r in out:
        if r.doc_id is not None and r.doc_id > 3:
            raw = texts[r.doc_id].encode()
            assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    assert len({r.shard for r in out if r.doc_id is None}) == 1
    assert [(r.size, r.text_crc32) for r in out if r.doc_id == 1 and r.size == 8][:2]
    assert sharding.shard(table(spark, []), tree).count() == 0


def test_weights_confine_movement(spark):
    before = sharding.HashTree((((1.0, 2.0), (1.0,)), ((4.0,), (1.0, 1.0))))
    after = sharding.HashTree((((1.0, 2.0), (1.0,)), ((4.0,), (1.0, 3.0))))
    rows = spark.range(8000).select(
        sharding.shard_of(F.col("id"), before).alias("a"), sharding.shard_of(F.col("id"), after).alias("b")
    ).collect()
    shares = Counter(r.a for r in rows)
    for s, w in enumerate([1, 2, 1, 4, 1, 1]):
        assert abs(shares[s] / 8000 - w / 10) < 0.03
    region = [0, 0, 0, 1, 1, 1]
    for r in rows:  # only rows that stay in, or come to, the region that grew can move
        assert r.a == r.b or region[r.b] == 1


# ---- language model ----


def tokens_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def test_scores_equal_brute_force(spark):
    rng = random.Random(6)
    kinds = [["der", "die", "und", "ein"], ["the", "and", "of", "one"]]
    rows = [(i, " ".join(rng.choice(kinds[i % 2]) for _ in range(rng.randrange(0, 30)))) for i in range(200)]
    rows += ODD
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    out = hmm.score_texts(table(spark, rows), held).collect()
    is_held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts = Counter(t for i, text in rows if not is_held(i) for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, text in rows:
        seen = tokens_of(text)
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in seen)
        want.append((-1 if i is None else i, is_held(i), len(seen), sum(counts[t] > 0 for t in seen), n, round(base, 6)))
    found = [(-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out]
    assert sorted(found) == sorted(want)
    gain = [r.score - r.base_score for r in out if r.held_out and r.n_tokens > 5]
    assert np.median(gain) > 0  # order tells the chain more than counts alone


def test_forward_equals_the_plain_recursion():
    rng = np.random.default_rng(2)
    chain = hmm._first_chain()
    counts = np.array([5, 1, 9, 3])
    symbols = rng.integers(0, hmm.SYMBOLS, counts.sum())
    likely = hmm.forward(chain, symbols, counts)
    at = 0
    for i, n in enumerate(counts):
        a = chain.start * chain.emit[symbols[at]]
        for s in symbols[at + 1 : at + n]:
            a = (a @ chain.move) * chain.emit[s]
        assert np.isclose(likely[i], np.log(a.sum()))
        at += n
    starts, moves, emits, total = hmm.expected(chain, symbols, counts)
    assert np.isclose(starts.sum(), 4) and np.isclose(moves.sum(), counts.sum() - 4) and np.isclose(emits.sum(), counts.sum())
    assert np.isclose(total, likely.sum())
    better = hmm._updated(starts, moves, emits, within=1e-9)
    assert hmm.forward(better, symbols, counts).sum() > likely.sum()


def test_model_of_awkward_tables(spark):
    assert hmm.score_texts(table(spark, []), F.lit(False)).count() == 0
    out = hmm.score_texts(table(spark, ODD), F.lit(True)).collect()
    assert len(out) == len(ODD) and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in out)


# ---- token files ----

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_encode_like_whole_texts():
    texts = ["", None, " ", "  a  b ", "a <|endoftext|> b<|endoftext|>c", "x\u00a0 y \u3000z", "don't it's  \n\n foo\tbar   x é è ñ", "日本 語 テキスト です ",
             " lead", "trail ", "a \n b", "a\nb\n", "1,2.3;4 a,b c.d\n\ne", "\n", "a\n", "\nb", "é.\n è", "a\u2003b c", "x" * 5000, "A!!\r\nB?! c|d"]
    rng = random.Random(1)
    texts += ["".join(rng.choice("ab .,\n\t!é日\u00a0\u3000's1") for _ in range(60)) for _ in range(400)]
    encoder, whole = token_files.Encoder(PATH), Tokenizer.from_file(PATH)
    out = []
    for _, ids, counts in encoder.ids(pa.array(texts)):
        ends = np.cumsum(counts)
        out += [ids[e - c : e].tolist() for c, e in zip(counts, ends, strict=True)]
    assert out == [e.ids for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_TOKENS", 64)
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["the", "und", "日本", "x,y"]) for _ in range(rng.randrange(60)))) for i in rng.sample(range(10_000), 150)]
    rows += [(20_000, None), (20_001, ""), (None, "a b"), (20_002, "same"), (20_002, "same")]
    folder = scratch_dir(spark, "token-test")
    files = token_files.write_tokens(table(spark, rows), folder, PATH)
    whole = Tokenizer.from_file(PATH)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = [[*whole.encode(t or "", add_special_tokens=False).ids, 0] for _, t in ordered]
    out = sorted(token_files.read_tokens(files).collect(), key=lambda r: r.start)
    start = 0
    for r, (i, _), x in zip(out, ordered, ids, strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        start += len(x)
    # random access unpacks only what is asked for, and any zstandard reader unpacks all
    made = files.collect()
    for row in made:
        opened = token_files.TokenFile(row.path)
        assert len(opened.seek) == row.n_frames
        some = [i for i, _ in ordered if i is not None and len(opened.index) and opened.index["low"][0] <= i <= opened.index["high"][0]][:1]
        got = opened.documents(some)
        assert opened.unpacked <= 2 and {i for i, _ in got} == set(some)
        for i, tokens in got:
            assert tokens.tolist() in [x for (j, _), x in zip(ordered, ids, strict=True) if j == i]
        with open(row.path.removeprefix("file://"), "rb") as raw:
            body = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        assert len(body) == int(opened.seek[:, 1].sum())
    assert sum(r.n_docs for r in made) == len(rows)
    assert token_files.read_tokens(token_files.write_tokens(table(spark, []), scratch_dir(spark, "token-none"), PATH)).count() == 0


def test_damaged_frame_is_refused(spark, tmp_path):
    folder = scratch_dir(spark, "token-damage")
    path = token_files.write_tokens(table(spark, [(1, "some words here")]), folder, PATH).first().path.removeprefix("file://")
    raw = bytearray(open(path, "rb").read())
    raw[12] ^= 0xFF
    (tmp_path / "bad.zst").write_bytes(raw)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.TokenFile(str(tmp_path / "bad.zst")).frame(0)


# ---- awkward tables ----


def test_mixing_keeps_clashing_columns_and_makes_many_copies(spark):
    schema = "doc_id long, text string, source string, _source string, _parts int, _mix_copies int, _cumulated string"
    docs = spark.createDataFrame([(1, "a", "s", "x", 1, 7, "c"), (2, "b" * 50, "t", "y", 2, 8, "d"), (2, "b" * 50, "t", "y", 2, 8, "d")], schema)
    out = mixing.poisson_mix(docs)
    assert out.columns == [*docs.columns, "_copy", "_order"]
    assert out.where("_mix_copies NOT IN (7, 8) OR _source NOT IN ('x', 'y')").count() == 0
    # one byte against many: more copies than an array of them would hold in one lot
    many = mixing.poisson_mix(docs.where("doc_id = 1"), total=35_000.0).select("_copy").collect()
    assert sorted(r._copy for r in many) == list(range(1, len(many) + 1)) and 34_000 < len(many) < 36_000


def test_token_files_of_one_id_do_not_depend_on_partitions(spark, tmp_path):
    docs = spark.createDataFrame([(5, f"text {i % 90}") for i in range(300)], "doc_id long, text string")
    found = []
    for parts in (2, 5):
        files = token_files.write_tokens(docs.repartition(parts), str(tmp_path / f"t{parts}"), PATH)
        found.append(sorted(map(tuple, token_files.read_tokens(files).collect())))
    assert found[0] == found[1] and len(found[0]) == 300


def plain_shard(key, tree):
    """The weighted draws down the tree, with a hash library of its own."""

    def draw(path, weights):
        best = []
        for i, w in enumerate(weights):
            h = 42 if key is None else xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
            for part in (*path, i):
                h = xxhash.xxh64_intdigest(part.to_bytes(4, "little"), h)
            if w > 0:
                best.append((-math.log(((h >> 11) + 0.5) / 2**53) / w, i))
        return min(best)[1]

    region = draw((1,), [sum(map(sum, r)) for r in tree.regions])
    rack = draw((2, region), [sum(r) for r in tree.regions[region]])
    before = sum(len(k) for r in tree.regions[:region] for k in r) + sum(map(len, tree.regions[region][:rack]))
    return before + draw((3, region, rack), tree.regions[region][rack])


def test_placement_equals_draws_by_another_library(spark):
    tree = sharding.HashTree((((1.0, 2.0), (0.0, 3.0, 1.0)), ((0.5,),), ((1.0, 1.0, 1.0, 1.0),)))
    keys = [None, 0, -1, 2**63 - 1, -(2**63), *range(1, 600)]
    docs = spark.createDataFrame([(k, "text") for k in keys], "doc_id long, text string")
    found = {r.doc_id: (r.shard, r.grown_shard) for r in sharding.shard(docs, tree).collect()}
    assert found == {k: (plain_shard(k, tree), plain_shard(k, tree.grown())) for k in keys}


def test_hmm_asks_once_a_block_but_hashes_small_pieces(monkeypatch):
    """Working arrays of a whole block of 16 MB took most of an executor's memory."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 5_000, 1_500)) for _ in range(400)]
    sizes, plain = [], hmm.words.word_hashes
    monkeypatch.setattr(hmm.words, "word_hashes", lambda data, offsets: sizes.append(len(data)) or plain(data, offsets))
    batch = pa.RecordBatch.from_arrays([pa.array([3] * 390 + [4] * 10), pa.array(texts)], names=["block", "text"])
    found = list(hmm._ask(iter([batch])))
    assert max(sizes) <= 1 << 20 < sum(map(len, texts[:390]))
    assert [set(b.column("block").to_pylist()) for b in found] == [{3}, {4}]
    for b, part in zip(found, (texts[:390], texts[390:]), strict=True):
        tokens = b.column("token").to_pylist()
        assert len(tokens) == len(set(tokens)) == len({w for t in part for w in t.split()}) + 1
