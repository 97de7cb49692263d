"""Spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from tessera.llm import spelling
from tests.llm.frames import DOCS, awkward, frame

WORDS = "word string, n long"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain(counts, ratio=2):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


def got(spark, counts, **how):
    df = spark.createDataFrame(list(counts.items()), WORDS)
    return {tuple(r) for r in spelling.variants(df, **how).select("word", "form", "root", "n", "n_near", "form_n").collect()}


def crowd(n, letters, sizes, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.choice(sizes))) for _ in range(n)}
    return {w: rng.choice([3, 4, 6, 6, 9, 50, 120]) for w in words}


@pytest.mark.parametrize("partition", [2, 20, 20_000])
@pytest.mark.parametrize("letters, sizes", [("ab", [5, 6, 7, 8]), ("aéz", [5, 6, 9, 10, 11]), ("abcdefgh", [1, 2, 3, 4])])
def test_equals_brute_force(spark, partition, letters, sizes):
    counts = crowd(250, letters, sizes, len(letters))
    assert got(spark, counts, partition=partition) == plain(counts)


def test_crowded_prefix_is_divided(spark):
    """All words share a long prefix and suffix; partitions of four words."""
    counts = {f"begin{w}end": n for w, n in crowd(120, "abc", [3, 4, 5], 9).items()}
    assert got(spark, counts, partition=4) == plain(counts)


def test_rows_of_one_letter_and_ties(spark):
    counts = {"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaab": 6, "baaaa": 6, "aaaaaaaaaaa": 3, "zzzzz": 1,
              "ééééé": 3, "éééééé": 5}
    found = got(spark, counts)
    assert found == plain(counts)
    assert ("aaaaa", "aaaaaa", "aaaaaaa", 3, 3, 6) in found


def test_minimised_states_and_numbers():
    words = sorted(crowd(300, "abc", [6], 2))
    machine = spelling.Acceptor()
    start = machine.add(words)
    assert machine.words[start] == len(words)
    spelled = []
    stack = [(start, "", 0)]
    while stack:
        state, text, number = stack.pop()
        if state == 0:
            spelled.append((number, text))
        stack += [(t, text + c, number + before) for c, (t, before) in machine.arcs[state].items()]
    assert [w for _, w in sorted(spelled)] == words and sorted(n for n, _ in spelled) == list(range(len(words)))
    # Minimal: no two states spell the same, and fewer states than prefixes.
    rights = {}
    for state in range(len(machine.arcs)):
        rights[state] = frozenset(c + r for c, (t, _) in machine.arcs[state].items() for r in rights[t]) or frozenset([""])
    assert len(set(rights.values())) == len(rights) < len({w[:k] for w in words for k in range(7)})


def test_very_long_words_need_no_recursion(spark):
    base = "ab" * 3_000
    counts = {base: 9, base[:700] + "c" + base[700:]: 4, base[:-1]: 3, base + "b": 30, "a" * 5_000: 3, "a" * 5_001: 7}
    assert got(spark, counts) == plain(counts)


def plain_counts(rows, least_chars=5, least=3, noise=97):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if n >= least and len(w) >= least_chars}


@pytest.mark.parametrize("held", [3, 200_000])
def test_vocabulary(spark, held, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", held)
    rng = random.Random(6)
    stock = ["Été", "ÉCLAIRé", "naïve", "straße", "over×under", "œuvre", "seven", "Seventy", "don't", "x1yyyyy", "日本abcde"]
    texts = awkward() + [" ".join(rng.choice(stock) for _ in range(40)) for _ in range(60)]
    ids = [*range(len(texts) - 2), None, 3]
    noise = 5
    found = spelling.vocabulary(frame(spark, texts, ids, extra=True), noise=noise)
    assert {r.word: r.n for r in found.collect()} == plain_counts(zip(ids, texts), noise=noise)
    clean = spelling.vocabulary(frame(spark, texts, ids))
    assert {r.word: r.n for r in clean.collect()} == plain_counts([(None, t) for t in texts])


def test_query_and_empty_table(spark, tmp_path):
    from tessera.llm import queries

    rng = random.Random(8)
    stock = [w for w in crowd(60, "abc", [5, 6], 1)]
    texts = [" ".join(rng.choice(stock) for _ in range(50)) for _ in range(40)]
    frame(spark, texts, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_spelling_variants(spark, str(tmp_path))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in found.collect()} == plain(plain_counts(enumerate(texts)))
    empty = spark.createDataFrame([], DOCS)
    assert spelling.variants(spelling.vocabulary(empty)).count() == 0
    assert got(spark, {"alone": 3}) == {("alone", None, "alone", 3, 0, None)}
