"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

The patterns are word windows of the items. The automaton reads word numbers, not
characters: a window costs one node per word, and a match ends at a word. Texts
are scanned once; matched words are mapped back to character spans of the original.

Windows are made by Spark, as distinct pairs of window and item. What comes to the driver
and is broadcast is bounded: a larger benchmark is dealt by hash to several automata, a
window of very many items among them, and each costs one more pass over the written marks.

Defined results: a null or empty text has no words and is clean; an item without
words or without an id takes no part; ids of any type count by their text, and items of one
id are one; repeated documents are judged each by itself; an empty benchmark leaves every
document clean.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import alnum_words, fresh, map_columns, with_result
from tessera.session import materialize

WINDOW = 13
# Pairs of window and item per automaton, about: what a task holds and what is broadcast.
AUTOMATON_PAIRS = 200_000
SHARE = 20          # contaminated if at least one word in SHARE is hit

ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
RESULT = ("n_words long, n_hit long, covered array<struct<a:long,b:long>>, items array<string>, "
          "spans array<struct<start:long,end:long>>")


def windows(text: str | None, width: int) -> list[tuple[bytes, ...]]:
    words = alnum_words(text)
    return [tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []


def pairs(benchmark: DataFrame, item_id: str, item_text: str, width: int) -> DataFrame:
    """(window, item): every window of every item once; words joined by spaces."""
    def step(items, texts):
        rows = [(b" ".join(w), item) for item, text in zip(items, texts) for w in windows(text, width)]
        return [list(c) for c in zip(*rows)] or [[]] * 2

    named = benchmark.where(F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
    return map_columns(named, ["item", "text"], "window binary, item string", lambda: step).distinct()


def grouped(rows) -> dict[tuple[bytes, ...], set[str]]:
    """Windows with the items that hold them."""
    block: dict[tuple[bytes, ...], set[str]] = {}
    for window, item in rows:
        block.setdefault(tuple(bytes(window).split(b" ")), set()).add(item)
    return block


def automaton(block: dict) -> tuple[dict[bytes, int], ahocorasick.Automaton]:
    """Word numbers from 1 (0: in no window) and the automaton over them."""
    numbers: dict[bytes, int] = {}
    trie = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for window, ids in block.items():
        key = tuple(numbers.setdefault(w, len(numbers) + 1) for w in window)
        trie.add_word(key, (len(key), tuple(ids)))
    if block:
        trie.make_automaton()
    return numbers, trie


def scan(words: list[bytes], numbers: dict[bytes, int], trie) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged word intervals (end exclusive) covered by windows, and the items met."""
    covered: list[tuple[int, int]] = []
    found: set[str] = set()
    sequence = tuple([numbers.get(w, 0) for w in words])
    if not any(sequence):
        return covered, found
    for end, (length, ids) in trie.iter(sequence):
        found.update(ids)
        start, end = end + 1 - length, end + 1
        while covered and covered[-1][1] >= start:      # ends only grow
            start = min(start, covered.pop()[0])
        covered.append((start, end))
    return covered, found


def character_spans(text: str, covered: list[tuple[int, int]]) -> list[dict]:
    """Word intervals as character spans of the original text."""
    if not covered:
        return []
    places = [m.span() for m in ORIGINAL_WORD.finditer(text)]
    return [{"start": places[a][0], "end": places[b - 1][1]} for a, b in covered]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def mark(docs: DataFrame, benchmark: DataFrame, name: str, *, text: str = "text",
         item_id: str = "item_id", item_text: str = "text", width: int = WINDOW,
         most: int = AUTOMATON_PAIRS) -> DataFrame:
    """``docs`` with the struct ``name`` (RESULT): words hit, items met, character spans hit."""
    spark = docs.sparkSession
    every = materialize(pairs(benchmark, item_id, item_text, width), "windows")
    count = max(1, -(-every.count() // most))
    dealt = F.pmod(F.xxhash64("window", "item"), F.lit(count))
    out, used = None, None
    for number in range(count):
        shared = spark.sparkContext.broadcast(grouped(every.where(dealt == number).collect()))
        if out is None:
            out = with_result(docs, [text], RESULT, lambda shared=shared: _step(shared), name)
        else:       # one more pass over the written marks; the automaton before has done its part
            before = fresh(out, "before")
            out = materialize(out.withColumnRenamed(name, before), "decontaminate")
            used.destroy()
            out = with_result(out, [text, before], RESULT,
                              lambda shared=shared: _step(shared), name).drop(before)
        used = shared
    return out


def _step(shared):
    numbers, trie = automaton(shared.value)

    def step(texts, before=None):
        rows = []
        for k, text in enumerate(texts):
            words = alnum_words(text)
            covered, found = scan(words, numbers, trie) if numbers else ([], set())
            if before is not None:
                covered = merged([*covered, *((c["a"], c["b"]) for c in before[k]["covered"])])
                found |= set(before[k]["items"])
            rows.append((len(words), sum(b - a for a, b in covered),
                         [{"a": a, "b": b} for a, b in covered], sorted(found),
                         character_spans(text, covered)))
        return [list(column) for column in zip(*rows)] or [[]] * 5

    return step


def contaminated(name: str):
    """One word in SHARE or more lies in a window of a test item."""
    return (F.col(f"{name}.n_hit") > 0) & (SHARE * F.col(f"{name}.n_hit") >= F.col(f"{name}.n_words"))
