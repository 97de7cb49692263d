"""SimHash near-duplicates through pivot distance tables.

A pivot table holds the Hamming distances of every fingerprint to fixed reference
fingerprints. If two fingerprints differ in at most r bits, no distance differs by
more than r; pairs with a larger coordinate difference are discarded, survivors are
verified bit by bit.

The references come in families. A family's references differ from its first one
inside one block of bits only, so the family's distances, relative to the first,
describe that block alone. Of r + 1 blocks at least one holds no differing bit: for
some family all these coordinates are equal, and the pair meets in the bucket of
this family and its coordinates. A bucket with more than ``BUCKET`` fingerprints is
divided again: the bits its path has not used are cut into r + 1 blocks, of which
again one is free of differences, and the families of these blocks extend the
coordinates. Nothing is lost, no bucket grows with the data, and when the bits run
out a bucket cannot hold more than a few distinct fingerprints.

Exact copies share a fingerprint and are represented by it; a bucket links its
members in a forest, not in all pairs. Components are found on fingerprints.

Defined results: texts without words (null, empty, white space) have fingerprint
zero and are linked like any other; repeated rows and ids are rows of their own;
a null id cannot be the smallest of its component, which is null only if all are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import LOWER, fresh, with_result
from tessera.llm.components import components
from tessera.session import materialize

WORDS = 3           # words of a shingle
DISTANCE = 3        # differing bits of a link, at most
SEED = 42
BUCKET = 1_024      # fingerprints compared within one bucket, at most
REFERENCES = 8      # of a family, beside its first
HASHES_AT_ONCE = 65_536


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64 bits, each 1 if set in over half of the shingle hashes; as a signed number."""
    tokens = (text or "").encode().translate(LOWER).split()
    if not tokens:
        return 0
    h = xxhash.xxh64_intdigest
    n = max(1, len(tokens) - words + 1)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, HASHES_AT_ONCE):
        some = tokens[a:min(n, a + HASHES_AT_ONCE) + words - 1]
        if len(some) < words:
            shingles = [b" ".join(some)]
        else:
            shingles = map(b" ".join, zip(*(some[k:] for k in range(words))))
        hashes = np.array([h(s, SEED) for s in shingles], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, name: str, *, text: str = "text", words: int = WORDS) -> DataFrame:
    """``docs`` with the long column ``name``."""
    holder = fresh(docs, "held")
    made = with_result(docs, [text], "bits long", lambda: lambda texts: ([fingerprint(t, words) for t in texts],),
                       holder)
    return made.withColumn(name, F.col(f"{holder}.bits")).drop(holder)


# Blocks, families and coordinates ------------------------------------------------------------

def free_blocks(path: tuple[int, ...], distance: int) -> list[int]:
    """Masks of the blocks into which the bits not used by ``path`` are cut."""
    bits = list(range(64))
    for step in path:
        blocks = _cut(bits, distance + 1)
        bits = [b for k, block in enumerate(blocks) if k != step for b in block]
    return [sum(1 << b for b in block) for block in _cut(bits, distance + 1)]


def _cut(bits: list[int], parts: int) -> list[list[int]]:
    edges = [len(bits) * k // parts for k in range(parts + 1)]
    return [bits[a:b] for a, b in zip(edges, edges[1:])]


def family(mask: int, count: int = REFERENCES) -> np.ndarray:
    """References of a block: the first, then ``count`` others that differ from it in the block only.

    The first ones flip single bits, so that together they tell all bits of a small
    block apart; with blocks of more bits than references the rest flip halves of it.
    """
    bits = [b for b in range(64) if mask >> b & 1]
    rng = np.random.default_rng([mask >> 32, mask & 0xFFFFFFFF])
    base = int(rng.integers(0, 2**63))
    others = []
    for k in range(max(count, len(bits))):
        flips = [bits[k]] if k < len(bits) else [b for b in bits if rng.random() < 0.5]
        others.append(base ^ sum(1 << b for b in flips))
    return np.array([base, *others], np.uint64)


def distances(fingerprints: np.ndarray, references: np.ndarray) -> np.ndarray:
    """The pivot distance table: a row per fingerprint, a column per reference."""
    return np.bitwise_count(fingerprints[:, None] ^ references[None, :]).astype(np.int16)


def bucket_of(fingerprints: np.ndarray, mask: int) -> np.ndarray:
    """A number naming the coordinates relative to the first reference of the block's family."""
    table = distances(fingerprints, family(mask))
    relative = table[:, 1:] - table[:, :1]
    weights = np.random.default_rng(mask % 2**32).integers(1, 2**62, relative.shape[1], np.int64)
    with np.errstate(over="ignore"):
        return (relative.astype(np.int64) * weights).sum(1)


# Far references, used to discard pairs inside a bucket.
PIVOTS = np.random.default_rng(20).integers(0, 2**63, 12).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _divide(distance: int):
    """Rows (fp, path, bucket) to one row per free block: the longer path and its bucket."""

    def run(batches):
        for batch in batches:
            fps = np.asarray(batch.column("fp")).view(np.uint64)
            paths = batch.column("path").to_pylist()
            old = np.asarray(batch.column("bucket"))
            out_fp, out_path, out_bucket = [], [], []
            for path in sorted(set(paths)):
                own = np.array([p == path for p in paths])
                steps = tuple(map(int, path.split("."))) if path else ()
                for k, mask in enumerate(free_blocks(steps, distance)):
                    if mask:
                        out_fp.append(fps[own].view(np.int64))
                        out_path += [f"{path}.{k}" if path else str(k)] * int(own.sum())
                        with np.errstate(over="ignore"):
                            out_bucket.append(bucket_of(fps[own], mask) + old[own] * np.int64(0x1000003))
            if out_fp:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_fp)), pa.array(out_path), pa.array(np.concatenate(out_bucket))],
                    names=["fp", "path", "bucket"])

    return run


def linked_pairs(fps: np.ndarray, group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``distance`` bits inside groups; rows sorted by (group, first pivot distance).

    Partner by partner in sorted order: a row's partners end where the first
    coordinate differs by more than ``distance``. The other coordinates discard most
    pairs left, the bits decide the rest.
    """
    table = distances(fps, PIVOTS)
    first = table[:, 0]
    found_a, found_b = [], []
    rows = np.arange(len(fps))
    lag = 1
    while len(rows):
        rows = rows[rows + lag < len(fps)]
        a, b = rows, rows + lag
        near = (group[a] == group[b]) & (first[b] - first[a] <= distance)
        rows = rows[near]       # sorted: later partners are farther
        a, b = a[near], b[near]
        for k in range(1, table.shape[1]):
            if not len(a):
                break
            keep = np.abs(table[a, k] - table[b, k]) <= distance
            a, b = a[keep], b[keep]
        if len(a):
            same = np.bitwise_count(fps[a] ^ fps[b]) <= distance
            found_a.append(a[same])
            found_b.append(b[same])
        lag += 1
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of the pairs those that join two trees: as good for components, and fewer than nodes."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = up = parent.get(up, up)
            x = up
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = top(x), top(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            kept.append((x, y))
    return kept


def _compare(distance: int):
    """Sorted rows (path, bucket, fp) to links; the last bucket of a batch waits for the next batch."""

    def links(paths, buckets, fps):
        change = np.ones(len(fps), bool)
        change[1:] = (buckets[1:] != buckets[:-1]) | (paths[1:] != paths[:-1])
        group = np.cumsum(change)
        order = np.lexsort((distances(fps, PIVOTS[:1])[:, 0], group))
        fps, group = fps[order], group[order]
        a, b = linked_pairs(fps, group, distance)
        # A pair of the forest stays within its bucket, so one forest serves all.
        kept = forest(a, b)
        values = fps.view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(values[[x for x, _ in kept]], pa.int64()), pa.array(values[[y for _, y in kept]], pa.int64())],
            names=["x", "y"])

    def run(batches):
        held = None
        for batch in batches:
            new = (np.array(batch.column("path").to_pylist(), object), np.asarray(batch.column("bucket")),
                   np.asarray(batch.column("fp")).view(np.uint64))
            if held is not None:
                new = tuple(np.concatenate(x) for x in zip(held, new))
            paths, buckets, fps = new
            if not len(fps):
                continue
            last = (paths == paths[-1]) & (buckets == buckets[-1])
            held = tuple(x[last] for x in new)
            if not last.all():
                yield links(*(x[~last] for x in new))
        if held is not None and len(held[2]):
            yield links(*held)

    return run


def links(fingerprints: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Pairs (x, y) of distinct fingerprints that connect all within ``distance`` bits of each other.

    ``fingerprints``: distinct values in the long column ``fp``.
    """
    schema = "fp long, path string, bucket long"
    # Divisions after which a block could be empty; by then a bucket has few members at most.
    bits, deepest = 64, 0
    while bits > distance:
        bits, deepest = bits - -(-bits // (distance + 1)), deepest + 1
    open_rows = fingerprints.select("fp", F.lit("").alias("path"), F.lit(0).cast("long").alias("bucket"))
    found = None
    while True:
        divided = materialize(open_rows.mapInArrow(_divide(distance), schema), "buckets")
        crowded = materialize(divided.groupBy("path", "bucket").count()
                              .where((F.col("count") > bucket) & (F.length("path") < 2 * deepest - 1))
                              .select("path", "bucket"), "crowded")
        some = not crowded.isEmpty()
        small = divided.join(crowded, ["path", "bucket"], "left_anti") if some else divided
        # Buckets hold at most ``bucket`` rows here, whatever the data.
        made = (small.repartition("path", "bucket").sortWithinPartitions("path", "bucket", "fp")
                .mapInArrow(_compare(distance), "x long, y long"))
        made = materialize(made, "links")
        found = made if found is None else found.unionByName(made)
        if not some:
            return found
        open_rows = divided.join(crowded, ["path", "bucket"], "left_semi")


def groups(distinct: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """(fp, smallest) for every row of ``distinct`` (fp, first): the smallest ``first`` in its component."""
    reached = components(links(distinct.select("fp"), distance, bucket)
                         .select(F.col("x").alias("a"), F.col("y").alias("b")))
    member = distinct.join(reached, distinct.fp == reached.node).select("fp", "first", "root")
    smallest = member.groupBy("root").agg(F.min("first").alias("smallest"))
    moved = member.join(smallest, "root").select(F.col("fp").alias("node"), "smallest")
    named = (distinct.join(moved, F.col("fp") == F.col("node"), "left")
             .select("fp", F.coalesce("smallest", "first").alias("smallest")))
    return materialize(named, "groups")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
                    distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``."""
    marked = with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "fp",
                              words=words)
    rows = materialize(marked.select("doc_id", "fp"), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    return (rows.join(groups(distinct, distance), "fp")
            .select("doc_id", "fp", F.col("smallest").alias("component_id")))


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
             distance: int = DISTANCE) -> DataFrame:
    """The row of smallest id of every component (of equal ids any one), with the columns of ``docs``.

    Rows get a number when they are written with their fingerprint, so repeated rows
    can be told apart; the number is fixed by the write.
    """
    fp, row = fresh(docs, "fp"), fresh(docs, "row")
    rows = materialize(with_fingerprint(docs, fp, text=text, words=words)
                       .withColumn(row, F.monotonically_increasing_id()), "fingerprinted")
    order = F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.col(row).alias("row"))
    distinct = materialize(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(order).alias("first")), "distinct")
    kept = groups(distinct, distance).select(F.col("smallest.row").alias(row)).distinct()
    return rows.join(kept, row, "left_semi").select(*docs.columns)
