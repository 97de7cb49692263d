"""Spelling variant grouping by finite-state composition.

Two words are near if one inserted, deleted or replaced code point turns one into the other: if the
composition  vocabulary acceptor o one-edit transducer o vocabulary acceptor  accepts the pair. Its
start is a state in which nothing has been edited yet, both sides having read the same prefix; after
the edit both must read the same rest.

1. Words are counted in the tasks that read the texts, then by Spark.
2. The composition is cut at its initial states. A pair whose shorter word has c code points is equal
   before or after the edit over c // 2 of them, so it is accepted from the state after the common
   first half, or, with the edit in the first half only, among words of a common last half. A
   partition holds the words of one such half, of lengths c and c + 1.
3. A partition of more than ``PARTITION`` words is cut again in the same way, at the middle of
   what its words do not share, until all are small. Every pair belongs to exactly one partition
   of each cut, so results are the same whatever the limit.
4. Inside a partition the words of each length become a minimised acceptor (states of equal right
   language are one). The composition walks both acceptors together and enumerates its accepted
   pairs; a pair of equal states is accepted with all it spells, without a walk. Each pair is
   counted at both its words, and a word leaves the partition in one row with its count and its most
   frequent near word, not in a row per pair.
5. A word's form is its near word of the largest count, if that is ``ratio`` times its own or more.
   Counts grow along forms, so there is no circle; roots are found by doubling pointers.

Defined results: null and empty texts have no words; repeated rows count each time; of equally
frequent near words the first in code-point order is the form; in rows with a null id no code point is
deleted (see ``noise``); words of any length are handled, without recursion. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import LOWER
from tessera.session import materialize

LEAST_CHARS = 5
LEAST_COUNT = 3
RATIO = 2
PARTITION = 20_000      # words of a partition that one task composes at once
HELD_WORDS = 200_000    # words counted in a task before they are handed on

_RUN = re.compile("[a-zÀ-ÿ]+")


# ---------------------------------------------------------------- vocabulary

def spoiled(word: str, h: int) -> str:
    at = h % len(word)
    return word[:at] + word[at + 1:]


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, least_chars: int = LEAST_CHARS,
               least_count: int = LEAST_COUNT, noise: int | None = None) -> DataFrame:
    """(word, n): runs of letters with A-Z lower-cased, of enough code points and occurrences.

    ``noise`` plants misspellings: where it divides the crc32 h of ``<doc_id>:<run>``, code point
    ``h % length`` of the run is deleted.
    """

    def count(batches):
        held: dict[str, int] = {}

        def record():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for one, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not t:
                    continue
                start = None if noise is None or one is None else zlib.crc32(f"{one}:".encode())
                for word, n in Counter(_RUN.findall(t.encode().translate(LOWER).decode())).items():
                    if len(word) < least_chars:
                        continue
                    if start is not None:
                        h = zlib.crc32(word.encode(), start)
                        if h % noise == 0:
                            word = spoiled(word, h)
                            if len(word) < least_chars:
                                continue
                    held[word] = held.get(word, 0) + n
                if len(held) >= HELD_WORDS:
                    yield record()
                    held = {}
        yield record()

    parts = docs.select(doc_id, text).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---------------------------------------------------------------- composition

class Acceptor:
    """Minimised acceptors of sets of words of one length each, over shared states.

    A state is its arcs: code point -> (state, words before it in order). State 0 ends a word. Paths are
    numbered in order, so a pair of paths names its words without spelling them.
    """

    def __init__(self) -> None:
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]
        self.words = [1]
        self._known: dict[tuple, int] = {}

    def _state(self, arcs: list[tuple[str, int]]) -> int:
        key = tuple(arcs)
        state = self._known.get(key)
        if state is None:
            placed, before = {}, 0
            for c, target in arcs:
                placed[c] = (target, before)
                before += self.words[target]
            state = self._known[key] = len(self.arcs)
            self.arcs.append(placed)
            self.words.append(before)
        return state

    def add(self, words: list[str]) -> int | None:
        """The initial state of distinct ``words`` of one length, in order; None without words."""
        if not words:
            return None
        size = len(words[0])
        # open[k]: finished arcs of the state after k code points of the word before.
        open_arcs: list[list[tuple[str, int]]] = [[] for _ in range(size)]
        last = words[0]
        for word in words[1:]:
            shared = 0
            while word[shared] == last[shared]:
                shared += 1
            self._close(open_arcs, last, shared)
            last = word
        return self._close(open_arcs, last, -1)

    def _close(self, open_arcs: list, word: str, upto: int) -> int:
        """Finish the states reached after more than ``upto`` code points of ``word``; returns the shallowest."""
        target = 0
        for k in range(len(word) - 1, max(upto, 0) - 1, -1):
            open_arcs[k].append((word[k], target))
            if k > upto:
                target = self._state(open_arcs[k])
                open_arcs[k] = []
        return target

    def common(self, a: int, b: int, without: str | None = None) -> Iterator[tuple[int, int]]:
        """Numbers, from a and from b, of the words both spell; none that begin with ``without``."""
        stack = [(a, b, 0, 0)]
        while stack:
            a, b, i, j = stack.pop()
            if a == b and without is None:
                for k in range(self.words[a]):
                    yield i + k, j + k
                continue
            other = self.arcs[b]
            for c, (x, before) in self.arcs[a].items():
                if c != without and c in other:
                    y, after = other[c]
                    stack.append((x, y, i + before, j + after))
            if a == b == 0:
                yield i, j      # nothing left to spell, hence nothing that begins with ``without``
            without = None

    def pairs(self, short: int, long: int | None, below: int) -> Iterator[tuple[bool, int, int]]:
        """Accepted pairs of the composition from these initial states, edited after fewer than ``below`` code points.

        (False, i, j): a code point of short word i replaced gives short word j. (True, i, j): one inserted
        into short word i gives long word j. An insertion into a row of equal code points counts at its end.
        """
        stack = [(short, long, 0, 0, 0)]
        while stack:
            s, t, depth, i, j = stack.pop()
            if depth >= below or t is None and self.words[s] < 2:
                continue
            arcs = list(self.arcs[s].items())
            for k, (_, (x, before)) in enumerate(arcs):
                for _, (y, after) in arcs[k + 1:]:
                    for p, q in self.common(x, y):
                        yield False, i + before + p, i + after + q
            others = {} if t is None else self.arcs[t]
            for c, (y, after) in others.items():
                for p, q in self.common(s, y, c):
                    yield True, i + p, j + after + q
            for c, (x, before) in arcs:
                y, after = others.get(c, (None, 0))
                stack.append((x, y, depth + 1, i + before, j + after))


def compose(short: list[tuple[str, int]], long: list[tuple[str, int]], head: int, tail: int,
            below: int) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, largest count among them, the first word of that count) of a partition.

    ``short`` and ``long`` are (word, count) in order, all with the same ``head`` first and ``tail``
    last code points; edits lie before code point ``below``.
    """
    acceptor = Acceptor()
    middles = lambda rows: [w[head:len(w) - tail] for w, _ in rows]
    starts = [acceptor.add(middles(rows)) for rows in (short, long)]
    near = [[0] * len(short), [0] * len(long)]
    best: list[list] = [[None] * len(short), [None] * len(long)]
    for longer, i, j in acceptor.pairs(*starts, below - head):
        for side, at, (word, n) in ((0, i, (long if longer else short)[j]), (int(longer), j, short[i])):
            near[side][at] += 1
            known = best[side][at]
            if known is None or (-n, word) < known:
                best[side][at] = (-n, word)
    for rows, counts, found in zip((short, long), near, best):
        for (word, _), count, top in zip(rows, counts, found):
            if count:
                yield word, count, -top[0], top[1]


def _compose_partitions(batches):
    """Rows sorted by partition, then word; a partition may span batches."""
    schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
    part, short, long, how, out = None, [], [], None, []

    def record():
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [()] * 4, schema)], schema=schema)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("part", "word", "n", "c", "head", "tail", "below")]
        for one, word, n, c, head, tail, below in zip(*columns):
            if one != part:
                if short and len(short) + len(long) > 1:
                    out += compose(short, long, *how)
                part, short, long, how = one, [], [], (head, tail, below)
                if len(out) > 10_000:
                    yield record()
                    out = []
            (short if len(word) == c else long).append((word, n))
    if short and len(short) + len(long) > 1:
        out += compose(short, long, *how)
    yield record()


def _named(entries: DataFrame) -> DataFrame:
    """The partition's name: what its words share, and where edits may lie."""
    return entries.withColumn("part", F.concat_ws(
        ":", "c", "head", "tail", "below", F.expr("substring(word, 1, head)"),
        F.expr("substring(word, length(word) - tail + 1, tail)")))


def _halves(entries: DataFrame) -> DataFrame:
    """Each row in the two partitions that share half of the middle more: with the edit behind it, or before it."""
    half = F.expr("(c - head - tail) DIV 2").cast("int")
    after = F.struct((F.col("head") + half).alias("head"), F.col("tail").alias("tail"), F.col("below").alias("below"))
    before = F.struct(F.col("head").alias("head"), (F.col("tail") + half).alias("tail"),
                      F.least(F.col("below"), F.col("head") + half).alias("below"))
    cut = entries.select("word", "n", "c", F.explode(F.array(after, before)).alias("p")).select("word", "n", "c", "p.*")
    return _named(cut.where("head < below"))


def near_words(words: DataFrame, partition: int = PARTITION) -> DataFrame:
    """(word, near, best_n, best) of the words of ``words`` (word, n) that have near words."""
    size = F.char_length("word")
    least = words.agg(F.min(size)).first()[0]
    whole = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("c")).where(F.col("c") >= (least or 0))
    whole = whole.select("*", F.lit(0).alias("head"), F.lit(0).alias("tail"), (F.col("c") + 1).alias("below"))
    entries, small = _halves(whole), None
    while True:
        # A middle of one code point cannot be cut, and spells a bounded number of words.
        crowded = materialize(entries.where("c - head - tail > 1").groupBy("part").count()
                              .where(F.col("count") > partition).select("part"), "crowded")
        more = crowded.isEmpty()
        ready = entries if more else entries.join(crowded, "part", "left_anti")
        small = ready if small is None else small.unionByName(ready)
        if more:
            break
        entries = materialize(_halves(entries.join(crowded, "part", "left_semi").drop("part")), "entries")
    found = (small.repartition("part").sortWithinPartitions("part", "word")
             .mapInArrow(_compose_partitions, "word string, near long, best_n long, best string"))
    first = F.min(F.struct((-F.col("best_n")).alias("order"), "best"))
    return found.groupBy("word").agg(F.sum("near").alias("near"), first.alias("top")).select(
        "word", "near", (-F.col("top.order")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the last word on the way; each round doubles the steps."""
    pointers = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        up = pointers.select(F.col("word").alias("root"), F.col("root").alias("above"))
        jumped = materialize(pointers.join(up, "root", "left").select(
            "word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "forms")
        pointers = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return pointers


def variants(words: DataFrame, ratio: int = RATIO, partition: int = PARTITION) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words`` (word, n; each word once)."""
    words = materialize(words, "words")
    frequent = F.col("best_n") >= ratio * F.col("n")
    known = materialize(words.join(near_words(words, partition), "word", "left").select(
        "word", "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best")).alias("form"), F.when(frequent, F.col("best_n")).alias("form_n")), "near")
    last = roots(known.where("form IS NOT NULL"))
    return known.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
