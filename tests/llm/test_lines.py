"""Line dedup against brute force, and the plan of its merge-anti-joins."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import lines
from tests.llm.frames import DOCS, awkward, frame, prose

BLANKS = " \t\n\x0b\x0c\r"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, chars=40, docs=5):
    """(id, n_lines, n_dropped, text) of (id, text) rows."""
    keys = lambda t: [lowered(line.strip(BLANKS)) for line in (t or "").split("\n")]
    holders = {}
    for i, t in rows:
        for k in keys(t):
            if i is not None and len(k) >= chars:
                holders.setdefault(k, set()).add(i)
    out = []
    for i, t in rows:
        stays = [line for line, k in zip((t or "").split("\n"), keys(t))
                 if i is None or len(holders.get(k, ())) < docs or max(holders[k]) <= i]
        whole = (t or "").split("\n")
        out.append((i, len(whole), len(whole) - len(stays), "\n".join(stays)))
    return sorted(out, key=str)


def got(df, **how):
    found = lines.remove_repeated_lines(df, "made", **how).select("doc_id", "made.*").collect()
    return sorted((tuple(r) for r in found), key=str)


def pages(n, seed):
    """Documents whose lines come from a small stock, in different dress."""
    rng = random.Random(seed)
    stock = [prose(9, 100 + k) for k in range(12)] + ["short line", "É" * 39, "é" * 40, "É" * 40, "ÀB" * 20, "Àb" * 20, ""]
    dress = [lambda s: s, str.upper, lambda s: f" \t{s}\r", lambda s: f"\x0b{s}\x0c ", lambda s: f" {s}"]
    return ["\n".join(rng.choice(dress[:2] if rng.random() < 0.7 else dress)(rng.choice(stock)) for _ in range(rng.randrange(1, 9)))
            for _ in range(n)]


@pytest.mark.parametrize("batches, fanout", [(1, 2), (5, 2), (7, 3)])
def test_equals_brute_force(spark, batches, fanout):
    texts = awkward() + pages(60, batches)
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    df = frame(spark, texts, ids, extra=True)
    found = lines.remove_repeated_lines(df, "made", batches=batches, fanout=fanout)
    assert found.columns == [*df.columns, "made"]
    assert sorted((tuple(r) for r in found.select("doc_id", "made.*").collect()), key=str) == plain(list(zip(ids, texts)))


def test_repeated_rows_ties_and_null_ids(spark):
    line = prose(10, 7)
    texts = [line, line, line + "\n" + line, f"x\n{line}", line, line, f"{line}\nown", None, line.upper()]
    ids = [1, 1, 2, 3, 4, None, 5, 5, 5]        # five documents, two of id 1, three of id 5, one without
    want = plain(list(zip(ids, texts)))
    assert sum(r[2] for r in want) == 6 and got(frame(spark, texts, ids), batches=3, fanout=2) == want
    four = [r for r in zip(ids, texts) if r[0] != 3]
    assert all(r[2] == 0 for r in got(frame(spark, [t for _, t in four], [i for i, _ in four]), batches=2))


def test_one_line_in_every_document_and_a_very_long_text(spark):
    common = prose(12, 3)
    long = "\n".join(f"{common}" if k % 3 else prose(8, k) for k in range(6_000))
    texts = [f"{prose(5, k)}\n{common}\nend" for k in range(200)] + [long, long]
    rows = list(enumerate(texts))
    found = got(frame(spark, texts), batches=4, fanout=2)
    assert found == plain(rows) and sum(r[2] for r in found) == 200 + 4_000


def test_small_limits_and_empty_table(spark):
    texts = ["a\nb", "a\nB", "b", "a"]
    assert got(frame(spark, texts), least_chars=1, least_docs=2) == plain(list(enumerate(texts)), 1, 2)
    empty = spark.createDataFrame([], DOCS)
    assert got(empty) == []
    assert got(frame(spark, ["", None, ""], [1, 2, None])) == [(1, 1, 0, ""), (2, 1, 0, ""), (None, 1, 0, "")]


def test_runs_are_levelled_disjoint_and_met_without_a_shuffle(spark):
    runs = lines.LineRuns(spark, fanout=2)
    batch = lambda a, b: spark.range(a, b).select(
        F.unhex(F.md5(F.col("id").cast("string"))).alias("hash"), (100 - F.col("id")).alias("id"))
    try:
        for start in range(5):
            runs.add(batch(start * 10, start * 10 + 20))
        # Five runs, two of a level merged at a time: one of level 0, one of level 2.
        assert [len(level) for level in runs.levels] == [1, 0, 1]
        every = [r.hash for run in runs.runs() for r in run.collect()]
        assert len(every) == len(set(every)) == 60
        held = {r.holder for r in runs.holders(batch(0, 60)).collect()}
        assert held == set(range(41, 101))
        with lines._sorted_buckets(spark):
            a, b = runs.runs()
            plan = a.join(b.hint("merge"), "hash", "left_anti")._jdf.queryExecution().executedPlan().toString()
        for word, there in (("SortMergeJoin", True), ("Exchange", False), ("Sort [", False)):
            assert (word in plan) is there, plan
        # Five batches of twenty, each sharing ten hashes with the one before.
        assert sorted(r.repeats for r in runs.repeats().collect()) == [1] * 40
    finally:
        runs.close()


def test_no_python_in_the_plan(spark):
    plan = lines.remove_repeated_lines(frame(spark, pages(20, 2)), "made")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
