"""Substring dedup by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Its minimiser is the smallest hash of
``MINIMISER`` consecutive words in it. Consecutive windows with one minimiser form
a super-k-mer: one string, packed from their words, that travels to the bucket of
the minimiser. Equal windows have equal minimisers, so each bucket alone can count
its windows: they are sorted, and of each the first document is known.

1. Each document is reduced to its super-k-mers' places and minimisers. Documents
   of one word sequence are represented by the one of smallest id; the others lie
   entirely in windows of it.
2. A minimiser met in one document only holds no repeated window: only the shared
   ones' super-k-mers are cut from the texts and sent.
3. Equal strings are one, with the smallest document that has it: in all others every
   window of it is repeated. Buckets left with one string, or one document, are done.
4. A bucket's strings go to tasks in chunks of about ``CHUNK`` windows, one for nearly all
   buckets. A task sorts the windows of its chunk, so equal ones stand together and name
   their smallest document. Windows with an earlier one are marked. Where the bucket has
   other chunks, the rest leave as one digest per chunk and are compared with theirs: a
   window in a third of all documents leaves each chunk once, and no more rows leave than
   there are different windows.
5. The words covered by windows with an earlier document are removed.

Defined results: a null or empty text has no words; documents shorter than a window
lose nothing; rows of one id never remove words from each other; rows without an id
keep all their words, and no others depend on them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import map_columns, space_words, with_result
from tessera.session import materialize

WINDOW = 50
MINIMISER = 6
CHUNK = 65_536          # windows sorted at once; one super-k-mer has no more
WORDS_AT_ONCE = 65_536
NOTHING = hashlib.sha256(b"").hexdigest()

PLACES = "n_words long, sha256 string, starts array<int>, sizes array<int>, minimisers array<long>"


def minimisers(words: list[bytes], window: int = WINDOW, size: int = MINIMISER) -> tuple[list, list, list]:
    """Super-k-mers as (first window, number of windows, minimiser); numpy inside, in pieces of a long text."""
    starts, sizes, values = [], [], []
    last = len(words) - window + 1
    h = xxhash.xxh64_intdigest
    for a in range(0, max(last, 0), WORDS_AT_ONCE):
        n = min(last - a, WORDS_AT_ONCE)        # windows of this piece
        one = np.array([h(w) for w in words[a:a + n + window - 1]], np.uint64)
        with np.errstate(over="ignore"):
            grams = np.zeros(len(one) - size + 1, np.uint64)
            for k in range(size):
                grams = grams * np.uint64(0x9E3779B97F4A7C15) + one[k:k + len(grams)]
            grams ^= grams >> np.uint64(29)
            grams *= np.uint64(0xBF58476D1CE4E5B9)
            grams ^= grams >> np.uint64(32)
        # Sliding minimum over window - size + 1 grams by doubling.
        width, low = 1, grams
        whole = window - size + 1
        while 2 * width <= whole:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        rest = whole - width
        if rest:
            low = np.minimum(low[:len(low) - rest], low[rest:])
        cuts = np.flatnonzero(low[1:] != low[:-1]) + 1
        first = np.concatenate([[0], cuts])
        starts += (first + a).tolist()
        sizes += np.diff(np.concatenate([first, [n]])).tolist()
        values += low[first].view(np.int64).tolist()
    return starts, sizes, values


def _reduce(window: int):
    def step(texts):
        rows = []
        for text in texts:
            words = space_words(text)
            sha = hashlib.sha256(b" ".join(words)).hexdigest()
            rows.append((len(words), sha, *minimisers(words, window)))
        return [list(c) for c in zip(*rows)] or [[]] * 5

    return step


def _cut(window: int):
    """Packed strings of the wanted super-k-mers of each document."""
    def step(docs, keys, texts, wanted):
        rows = []
        for doc, key, text, places in zip(docs, keys, texts, wanted):
            words = space_words(text)
            for p in places:
                packed = b" ".join(words[p["start"]:p["start"] + p["size"] + window - 1])
                rows.append((p["minimiser"], doc, key, p["start"], p["size"], packed))
        return [list(c) for c in zip(*rows)] or [[]] * 6

    return step


def counted(strings: list[tuple[bytes, int, bytes]], window: int,
            alone: bool) -> list[tuple[bytes, int, list[int], bytes | None]]:
    """What a chunk says of its strings (name, smallest document, packed): (name, document, windows, digest).

    All windows are sorted by content, then document. Those with an earlier document in the chunk
    are listed per string, without a digest; of the others there is one row per string and content,
    unless the chunk is ``alone`` in its bucket.
    """
    every = []
    for at, (_, low, packed) in enumerate(strings):
        words = packed.split(b" ")
        every += [(b" ".join(words[k:k + window]), low, at, k) for k in range(len(words) - window + 1)]
    every.sort()
    out, repeated = [], {}
    content, smallest, own = None, None, None
    for words, low, at, k in every:
        if words != content:
            content, smallest, own = words, low, None
        if low > smallest:
            repeated.setdefault(at, []).append(k)
        elif alone:
            continue
        elif own == at:
            out[-1][2].append(k)
        else:
            own = at
            out.append((strings[at][0], low, [k], hashlib.blake2b(words, digest_size=16).digest()))
    return out + [(strings[at][0], strings[at][1], ks, None) for at, ks in repeated.items()]


def _sort_chunks(window: int):
    """Rows sorted by bucket and chunk, counted chunk by chunk; a chunk may span batches."""

    def run(batches):
        chunk, alone, held, out = None, True, [], []

        def record():
            made = list(zip(*out)) or [()] * 4
            types = (pa.binary(), pa.int64(), pa.list_(pa.int32()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(made, types)],
                                              names=["string", "low", "ks", "digest"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("minimiser", "chunk", "chunks", "string", "low", "packed")]
            for minimiser, number, chunks, *row in zip(*columns):
                if (minimiser, number) != chunk:
                    out += counted(held, window, alone)
                    chunk, alone, held = (minimiser, number), chunks == 1, []
                    if len(out) > 10_000:
                        yield record()
                        out = []
                held.append(tuple(row))
        out += counted(held, window, alone)
        yield record()

    return run


def _remove(window: int):
    def step(texts, marks):
        removed, sha = [], []
        for text, own in zip(texts, marks):
            words = space_words(text)
            gone = np.zeros(len(words) + 1, np.int64)
            for m in own:
                gone[m["first"]] += 1
                gone[min(m["last"] + window, len(words))] -= 1
            keep = np.cumsum(gone[:-1]) == 0
            kept = [w for w, k in zip(words, keep.tolist()) if k]
            removed.append(len(words) - len(kept))
            sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return removed, sha

    return step


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                   window: int = WINDOW, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs``."""
    # (doc_id, key) finds a text again in the second scan, also where ids are repeated.
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                        F.xxhash64(F.col(text)).alias("key"))
    rows = materialize(
        with_result(texts, ["text"], PLACES, lambda: _reduce(window), "places")
        .select("doc_id", "key", "places.*"), "places")

    # One document of each word sequence long enough for a window stands for all of them.
    long = rows.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    sequences = materialize(
        long.groupBy("sha256").agg(F.min(F.struct("doc_id", "key")).alias("one"), *(
            F.first(c).alias(c) for c in ("starts", "sizes", "minimisers")))
        .select("sha256", F.col("one.doc_id").alias("doc"), F.col("one.key").alias("key"),
                "starts", "sizes", "minimisers"), "sequences")

    kmers = sequences.select("doc", "key", F.explode(F.arrays_zip("starts", "sizes", "minimisers")).alias("k")) \
        .select("doc", "key", F.col("k.starts").alias("start"), F.col("k.sizes").alias("size"),
                F.col("k.minimisers").alias("minimiser"))
    shared = (kmers.groupBy("minimiser")
              .agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("minimiser"))
    wanted = (kmers.join(shared, "minimiser").groupBy("doc", "key")
              .agg(F.collect_list(F.struct("start", "size", "minimiser")).alias("wanted"))
              .withColumnRenamed("doc", "doc_id"))

    # The texts concerned, written once: super-k-mers are cut from them, and words removed.
    concerned = materialize(texts.join(wanted, ["doc_id", "key"]), "concerned")
    packed = materialize(map_columns(
        concerned, ["doc_id", "key", "text", "wanted"],
        "minimiser long, doc long, key long, start int, size int, packed binary", lambda: _cut(window)),
        "super-kmers").withColumn("string", F.unhex(F.substring(F.sha2("packed", 256), 1, 32)))

    strings = materialize(
        packed.groupBy("string").agg(F.min("doc").alias("low"), *(
            F.first(c).alias(c) for c in ("minimiser", "size", "packed"))), "strings")
    buckets = (strings.groupBy("minimiser")
               .agg(F.min("low").alias("least"), F.max("low").alias("most"), F.sum("size").alias("windows"))
               .where("least < most").select("minimiser", F.ceil(F.col("windows") / chunk).alias("chunks")))
    chunked = strings.join(buckets, "minimiser").select(
        "minimiser", F.pmod(F.xxhash64("string"), "chunks").alias("chunk"), "chunks", "string", "low", "packed")
    found = materialize(
        chunked.repartition("minimiser", "chunk").sortWithinPartitions("minimiser", "chunk")
        .mapInArrow(_sort_chunks(window), "string binary, low long, ks array<int>, digest binary"), "windows")

    # Chunks of one bucket are compared by the smallest document of each content.
    earliest = (found.where("digest IS NOT NULL").groupBy("digest")
                .agg(F.min("low").alias("smallest"), F.max("low").alias("largest"))
                .where("smallest < largest").select("digest", "smallest"))
    across = found.join(earliest, "digest").where("low > smallest").select("string", "ks")
    own = (found.where("digest IS NULL").select("string", "ks").unionByName(across)
           .groupBy("string").agg(F.flatten(F.collect_list("ks")).alias("ks")))
    # One row per super-k-mer of a document, also where rows are repeated, with all its marks.
    placed = (packed.select("doc", "key", "start", "size", "string").distinct()
              .join(strings.select("string", "low"), "string").join(own, "string", "left"))
    spread = placed.select("doc", "key", F.when(F.col("doc") > F.col("low"), F.array(F.struct(
        F.col("start").alias("first"), (F.col("start") + F.col("size") - 1).alias("last"))))
        .otherwise(F.transform("ks", lambda k: F.struct(
            (F.col("start") + k).alias("first"), (F.col("start") + k).alias("last")))).alias("m")) \
        .where("m IS NOT NULL")
    marks = (spread.groupBy(F.col("doc").alias("doc_id"), "key")
             .agg(F.flatten(F.collect_list("m")).alias("marks")))

    changed = with_result(concerned.select("doc_id", "key", "text").join(marks, ["doc_id", "key"]),
                          ["text", "marks"], "n_removed long, kept_sha256 string", lambda: _remove(window), "made")
    known = (sequences.select("sha256", "doc", "key")
             .join(changed.select(F.col("doc_id").alias("doc"), "key", "made").distinct(), ["doc", "key"], "left")
             .select("sha256", "doc", "made"))
    copy = F.col("doc") < F.col("doc_id")
    return rows.select("doc_id", "n_words", "sha256").join(known, "sha256", "left").select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).when(F.col("doc_id").isNull(), 0)
        .otherwise(F.coalesce("made.n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, NOTHING).when(F.col("doc_id").isNull(), F.col("sha256"))
        .otherwise(F.coalesce("made.kept_sha256", "sha256")).alias("kept_sha256"))
