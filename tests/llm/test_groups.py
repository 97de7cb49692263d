"""SimHash near-duplicates and substring dedup against brute force."""

import hashlib

import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash, substrings
from tests.llm.frames import DOCS, awkward, frame, prose


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, distance=3):
    label = dict(enumerate(ids))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= distance and label[j] < label[i]:
                    label[i], changed = label[j], True
    return [label[i] for i in range(len(ids))]


def test_fingerprints_and_components(spark):
    texts = awkward()
    base = prose(400, 9).split()
    texts += [" ".join(base[:k] + ["changed"] + base[k + 1:]) for k in range(0, 400, 40)]
    got = simhash.near_duplicates(frame(spark, texts, extra=True)).collect()
    prints = [plain_fingerprint(t) for t in texts]
    want = plain_components(list(range(len(texts))), prints)
    assert {r.doc_id: (r.fp % 2**64, r.component_id) for r in got} == {
        i: (prints[i], want[i]) for i in range(len(texts))}


@pytest.mark.parametrize("bucket", [3, 8, 1024])
def test_links_find_every_pair_also_when_buckets_divide(spark, bucket):
    import random

    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(4)]
    values = set(seeds)
    for s in seeds:     # chains and balls around each seed
        x = s
        for _ in range(25):
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 5])):
                x ^= 1 << b
            values.add(x)
    values = sorted(values)
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    distinct = spark.createDataFrame([(signed(v), i) for i, v in enumerate(values)], "fp long, first long")
    got = {r.fp % 2**64: r.smallest for r in simhash.groups(distinct, 3, bucket).collect()}
    want = plain_components(list(range(len(values))), values)
    assert [got[v] for v in values] == want


def test_keep_one(spark):
    texts = awkward()
    docs = frame(spark, [*texts, *texts], ids=[*range(len(texts)), *range(len(texts))], extra=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = set(plain_components(list(range(len(texts))), [plain_fingerprint(t) for t in texts]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_null_ids_and_empty_table(spark):
    docs = frame(spark, ["same words here", "same words here", "other words there now"], ids=[None, 7, None])
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(None, 7), (7, 7), (None, None)}
    assert simhash.keep_one(docs).count() == 2
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0
    assert substrings.remove_repeats(empty).count() == 0


def plain_removal(rows, window):
    first = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [40, 65_536])
def test_repeats(spark, chunk):
    passage = prose(80, 11)
    texts = awkward() + [prose(30, 20 + k) + " " + passage + " " + prose(k, 40 + k) for k in range(12)]
    texts += [passage + " " + passage, "\n".join(passage.split())]
    ids = [*range(len(texts) - 2), 3, None]
    docs = frame(spark, texts, ids=ids, extra=True)
    got = substrings.remove_repeats(docs, chunk=chunk).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_removal(list(zip(ids, texts)), 50)


@pytest.mark.parametrize("chunk", [20, 65_536])
def test_many_repeated_rows_and_a_repeated_word(spark, chunk):
    """500 rows of one id and text, and one word over and over in three documents."""
    passage = prose(70, 3)
    texts = [passage] * 500 + [f"{prose(9, k)} {passage} {prose(9, 50 + k)}" for k in range(30)]
    texts += ["a " * 400, "b " + "a " * 350 + "c", "a " * 90 + prose(20, 9) + " a" * 120]
    ids = [7] * 500 + [*range(8, 38), 40, 41, 42]
    got = substrings.remove_repeats(frame(spark, texts, ids=ids), chunk=chunk).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_removal(list(zip(ids, texts)), 50)


def test_a_chunk_leaves_each_content_once_per_string():
    common = [b"w%d" % k for k in range(60)]
    strings = [(b"s%d" % k, k, b" ".join([b"own%d" % k, *common])) for k in range(40)]
    rows = substrings.counted(strings, 50, False)
    known = [r for r in rows if r[3] is not None]
    # 11 windows of the common words leave once; each string's first window holds its own word.
    assert len(known) == 11 + 40 and len({r[3] for r in known}) == len(known)
    marked = [r for r in rows if r[3] is None]
    assert sorted((r[0], sorted(r[2])) for r in marked) == sorted((b"s%d" % k, list(range(1, 12))) for k in range(1, 40))
    assert substrings.counted(strings, 50, True) == marked


def test_small_windows_and_ties(spark):
    texts = ["a b a b a b", "a b a b", "b a b a", "c", "a b a b a b"]
    got = substrings.remove_repeats(frame(spark, texts), window=7).collect()
    assert all(r.n_removed == 0 for r in got)
    with_seven = ["a b c d e f g h", "x a b c d e f g", "a b c d e f g h"]
    got = substrings.remove_repeats(frame(spark, with_seven), window=7).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_removal(list(enumerate(with_seven)), 7)


def test_long_text_is_cut_in_pieces_alike(monkeypatch):
    words = prose(3_000, 6).encode().split()
    whole = substrings.minimisers(words)
    monkeypatch.setattr(substrings, "WORDS_AT_ONCE", 700)
    pieces = substrings.minimisers(words)
    spread = lambda m: [v for s, n, v in zip(*m) for _ in range(n)]
    assert spread(whole) == spread(pieces) and sum(whole[1]) == len(words) - 49


def test_fingerprint_in_pieces(monkeypatch):
    text = prose(2_000, 8)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 300)
    assert simhash.fingerprint(text) == whole
    assert whole % 2**64 == plain_fingerprint(text)


def test_fingerprint_matches_spark_hash(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()
    assert row.h % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)
