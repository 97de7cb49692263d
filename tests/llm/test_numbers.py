"""Top-k search, sharding and packing."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import kdsearch, kdshards, packing
from tessera.llm.common import gapless
from tests.llm.frames import DOCS, awkward, frame, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
VECTORS = "vec_id long, embedding array<float>, label string"


def vectors():
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)], "x") for i in range(260)]
    rows += [(300 + i, [0.5] * 6, "tie") for i in range(40)]                      # ties
    rows += [(400, None, "n"), (450, [0.1, None, 0.0, 0.0, 0.0, 0.0], "n"), (500, [float("nan")] * 6, "n"),
             (550, [float("inf")] * 6, "n"), (600, [1.0, 2.0], "short"), (650, [2.0, 1.0], "short"), (None, [0.3] * 6, "i"), (700, [], "e"),
             (701, [], "e")]
    return rows


@pytest.mark.parametrize("shard, regions", [(8192, 256), (40, 256), (10, 4)])
def test_top_k(spark, shard, regions, monkeypatch):
    monkeypatch.setattr(kdsearch, "REGIONS", regions)
    df = spark.createDataFrame(vectors(), VECTORS).withColumn("rank", F.lit("x"))
    got = kdsearch.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=shard).collect()
    usable = {i: [int(np.floor(np.float32(x).astype(float) * 256)) for x in v] for i, v, _ in vectors()
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q, a in usable.items():
        if q % 50 == 0:
            hits = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable.items()
                          if i != q and len(a) == len(b))[:5]
            want |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(hits)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_queries_go_only_where_a_box_could_beat_them(spark):
    """Eight clouds far apart: a query goes on to few regions, and a cell takes its queries in several batches."""
    rng = random.Random(6)
    rows = []
    for i in range(1600):
        centre = [(-1) ** (i % 8 >> b & 1) * 100.0 for b in range(3)]
        rows.append((i, [c + rng.uniform(-1, 1) for c in centre], "x"))
    df = spark.createDataFrame(rows, VECTORS)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "60")
    got = kdsearch.top_k(df, F.col("vec_id") % 4 == 0, shard_rows=200).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    points = np.floor(np.float32([v for _, v, _ in rows]).astype(float) * 256).astype(np.int64)
    scores = points @ points.T
    for r in got:
        own = sorted((-scores[r.query_id, i], i) for i in range(1600) if i != r.query_id)[r["rank"] - 1]
        assert (-own[0], own[1]) == (r.score, r.vec_id)
    assert len(got) == 400 * 5
    placed, regions = kdsearch._regions(kdsearch.quantised(df), 3, 1600, 200)
    assert len(regions) == 8 and sum(r.shards for r in regions) <= 12
    kth = {r.query_id: (r.score, r.vec_id) for r in got if r["rank"] == 5}
    asked = placed.where("vec_id % 4 = 0").select(F.lit(3).alias("dim"), "region", "shard", F.col("vec_id").alias("id"), "x").collect()
    known = spark.createDataFrame([(*r, *kth[r.id]) for r in asked], "dim int, region int, shard int, id long, x array<long>, "
                                  "kth_score long, kth_id long")
    assert known.mapInArrow(kdsearch._worth(regions), known.schema).count() < 400


def test_top_k_of_large_numbers_and_nothing(spark):
    big = [(0, [1e6] * 4, "a"), (50, [1e6, 1e6, 1e6, 0.9e6], "b"), (1, [-1e6] * 4, "c")]
    got = kdsearch.top_k(spark.createDataFrame(big, VECTORS), F.col("vec_id") % 50 == 0).collect()
    exact = {i: [int(np.float32(x)) * 256 for x in v] for i, v, _ in big}
    for r in got:
        assert r.score == sum(x * y for x, y in zip(exact[r.query_id], exact[r.vec_id]))
    assert len(got) == 4
    assert kdsearch.top_k(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0).count() == 0


def test_shards(spark):
    texts = [*awkward(), *(prose(20 + k % 9, k) for k in range(300))]
    docs = frame(spark, texts, extra=True)
    got = kdshards.shard(docs).collect()
    assert len(got) == len(texts)
    sizes, counts = np.zeros(16, int), {}
    for r in got:
        body = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(body) + 1, zlib.crc32(body))
        sizes[r.shard] += r.size
        counts.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in counts.values())


def plain_tree(rows, dims, shards):
    """Shard of every id; ``rows``: id -> (size, codes of the dimensions)."""
    spread = lambda ids, d: max(rows[i][1][d] for i in ids) - min(rows[i][1][d] for i in ids)
    whole = [max(1.0, spread(rows, d)) for d in range(dims)]
    out = {}

    def split(ids, first, count):
        if count == 1 or not ids:
            out.update(dict.fromkeys(ids, first))
            return
        widest = max(range(dims), key=lambda d: (spread(ids, d) / whole[d], -d))
        ordered = sorted(ids, key=lambda i: (rows[i][1][widest], i))
        target = sum(rows[i][0] for i in ids) * (count // 2) / count
        before, cut = 0, len(ordered)
        for k, i in enumerate(ordered):
            after = before + rows[i][0]
            if after >= target:
                cut = k + 1 if after - target <= target - before else k
                break
            before = after
        split(ordered[:cut], first, count // 2)
        split(ordered[cut:], first + count // 2, count - count // 2)

    split(list(rows), 0, shards)
    return out


@pytest.mark.parametrize("shards", [5, 16])
def test_shards_equal_a_plain_tree(spark, shards):
    """Sources share long beginnings; some are null, one holds a third of all rows."""
    rng = random.Random(11)
    sources = [None, "https://a.org", "https://zzz.com"] + [f"https://mirror.example/site-{k:02d}" for k in range(20)]
    texts = [prose(rng.randrange(1, 60), k) if k % 9 else None for k in range(500)]
    own = [sources[1] if k % 3 == 0 else rng.choice(sources) for k in range(500)]
    langs = [rng.choice(["en", "de", "", None]) for _ in range(500)]
    docs = spark.createDataFrame([(k, t, lang, s, 0) for k, (t, lang, s) in enumerate(zip(texts, langs, own))], DOCS).repartition(4)
    place = lambda values: {v: i for i, v in enumerate(sorted(set(values), key=lambda v: (v is not None, v or "")))}
    by_source, by_lang = place(own), place(langs)
    sizes = [len((t or "").encode()) + 1 for t in texts]
    rows = {k: (sizes[k], (by_source[own[k]], by_lang[langs[k]], sizes[k], k)) for k in range(500)}
    got = {r.doc_id: r.shard for r in kdshards.shard(docs, shards).collect()}
    assert got == plain_tree(rows, 4, shards)


def test_shards_of_equal_rows_and_near_equal_sizes(spark):
    docs = frame(spark, ["same text"] * 640, ids=[5] * 640)
    got = kdshards.shard(docs).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [40] * 16
    docs = frame(spark, [prose(30 + k % 5, k) for k in range(1600)])
    sizes = [r["sum(size)"] for r in kdshards.shard(docs).groupBy("shard").sum("size").collect()]
    assert max(sizes) - min(sizes) < 1_000
    three = [r["sum(size)"] for r in kdshards.shard(docs, 3).groupBy("shard").sum("size").collect()]
    assert len(three) == 3 and max(three) - min(three) < 1_000
    assert kdshards.shards_for(docs, sum(sizes) // 3 + 1) == 3


def test_shards_of_few_rows(spark):
    assert kdshards.shard(spark.createDataFrame([], DOCS)).count() == 0
    assert [r.slot for r in kdshards.shard(frame(spark, ["one"])).collect()] == [0]
    extreme = frame(spark, ["a", "b", "c"], ids=[-2**63, 2**63 - 1, None])
    assert kdshards.shard(extreme).count() == 3


def test_gapless(spark):
    df = spark.range(1000).selectExpr("id", "IF(id < 700, 'hot', 'cold') AS g")
    got = gapless(df, ["g"], ["id"], "n", chunk_rows=50).collect()
    for g, size in (("hot", 700), ("cold", 300)):
        assert sorted(r.n for r in got if r.g == g) == list(range(size))


def test_ids_equal_the_tokenizers(spark):
    tokens, plain = packing.Tokens(PATH), Tokenizer.from_file(PATH)
    texts = [t or "" for t in awkward()] + [
        "\n\n  a\t b \n", "it's I'll we'd '' 's!'s", "² ³ ¼ x²", "„ok“ … 5€", "a<|endoftext|>b", "\x1c\x1d a", "ª º !!!'s"]
    assert tokens.single != tokens._whole
    for t in texts:
        assert tokens.ids(t) == np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_pieces_and_packing(spark):
    texts = awkward()
    got = packing.pack(frame(spark, texts, extra=True), PATH).collect()
    plain = Tokenizer.from_file(PATH)
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for doc, rows in by_doc.items():
        ids = [*plain.encode(texts[doc] or "", add_special_tokens=False).ids, 2]
        at = 0
        for i, r in enumerate(sorted(rows, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at) and (i == 0 or r.length == 1024)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_packing_of_nothing_and_repeats(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), PATH).count() == 0
    got = packing.pack(frame(spark, ["same"] * 600, ids=[1] * 600), PATH).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 600 and len({r.sequence_id for r in got}) == 2


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece_in_few_sequences(seed):
    rng = np.random.default_rng(seed)
    demand = np.zeros(129, np.int64)
    for length in rng.integers(1, 129, 4_000) if seed % 2 else rng.geometric(0.05, 4_000).clip(1, 128):
        demand[length] += 1
    used = np.zeros(129, np.int64)
    sequences = 0
    for config, often in packing.plan(demand, 128, 60):
        assert sum(l * c for l, c in config.items()) <= 128 and often > 0
        sequences += often
        for l, c in config.items():
            used[l] += c * often
    assert (used == demand).all()
    assert sequences <= -(-(np.arange(129) * demand).sum() // 128) * 1.01 + 2


def test_best_answers_of_small_programs():
    demand = np.zeros(1025, np.int64)
    demand[[400, 520, 600]] = [100_000, 33_333, 777]      # 520+400, 600+400, then pairs of 400
    assert sum(m for _, m in packing.plan(demand)) == 33_333 + 777 + (100_000 - 33_333 - 777) // 2
