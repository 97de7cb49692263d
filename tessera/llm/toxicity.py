"""Toxicity: cumulative-link ordinal regression on sparse text features.

Grades are ordered: 0 clean, 1 toxic, 2 toxic with more of the vocabulary of toxic
documents than the median of them (labels say toxic or not; the grade adds how much).
One weight vector is shared by all thresholds: P(grade >= j) = sigmoid(w.x - t_j) with
t_1 < t_2; the output is the expected grade. Features are the distinct words of a text and their
beginnings and ends of 2 to 8 characters, which also catch inflected insults.
Features are screened by a G-test of association with toxicity, so that few remain.

The fit uses a sample of at most ``SAMPLE`` labelled documents (smallest hashes of
their ids; equal texts count once). Scoring reads every whole text.

Defined results: a null or empty text has no features and gets the grade of the
thresholds alone; without labels, or with labels of one kind only, every severity
is 0; a document id labelled twice is toxic if either says so; null ids carry none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import alnum_words, fresh, map_columns, with_result
from tessera.session import materialize

SAMPLE = 8_000          # labelled documents used for the fit, at most
FEATURES = 4_096        # features kept by the screening, at most
LEAST_G = 20.0          # a G statistic below this may be chance
EDGES = range(2, 9)     # characters of word beginnings and ends
L2, STEPS, RATE = 0.3, 400, 0.05
REJECT = 0.5            # expected severity from which a document goes
TASKS = 48              # tasks that work on the sample
CACHED_WORDS = 400_000  # words whose features a task remembers

RESULT = "severity double, at_least array<double>, grade int"


def word_features(word: str) -> list[str]:
    sizes = [k for k in EDGES if k <= len(word)]
    return [f"={word}", *(word[:k] for k in sizes), *(f"-{word[-k:]}" for k in sizes)]


def toxic_labels(labels: DataFrame, *, label_id: str = "doc_id", toxic: str = "toxic") -> DataFrame:
    """One (id, grade) per labelled document: 1 if toxic."""
    return (labels.select(F.col(label_id).alias("id"), F.col(toxic).cast("int").alias("grade"))
            .where("id IS NOT NULL AND grade IN (0, 1)")
            .groupBy("id").agg(F.max("grade").alias("grade")))


def sample(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
           size: int = SAMPLE) -> DataFrame:
    """(grade, text) of at most ``size`` labelled documents, written once.

    The chosen ids are at most ``size`` numbers, so sending them to every task is
    bounded, and the documents need no shuffle.
    """
    chosen = toxic_labels(labels).orderBy(F.xxhash64("id"), "id").limit(size)
    rows = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
            .join(F.broadcast(chosen), "id").where("text IS NOT NULL"))
    distinct = rows.groupBy("text").agg(F.max("grade").alias("grade"))
    return materialize(distinct.repartition(TASKS), "toxicity-sample")


def _count():
    def step(texts, grade):
        counts: dict[str, list[int]] = {}
        for text, g in zip(texts, grade):
            found = set()
            for word in set(alnum_words(text)):
                found.update(word_features(word.decode()))
            for feature in found:
                counts.setdefault(feature, [0, 0])[g > 0] += 1
        return list(counts), [c[0] for c in counts.values()], [c[1] for c in counts.values()]

    return step


def screen(rows: DataFrame, most: int = FEATURES, least: float = LEAST_G) -> dict[str, bool]:
    """The features most associated with toxicity, strongest first; true: toxic documents have it more often."""
    n0, n1 = rows.agg(F.expr("count_if(grade = 0)"), F.expr("count_if(grade > 0)")).first()
    if not n0 or not n1:
        return {}
    n = n0 + n1
    counts = (map_columns(rows, ["text", "grade"], "feature string, c0 long, c1 long", _count)
              .groupBy("feature").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")))

    def term(observed: str, row: str, column: int) -> str:
        return f"IF({observed} > 0, {observed} * ln({observed} * {n}D / (({row}) * {column}D)), 0D)"

    g = " + ".join([term("c0", "c0 + c1", n0), term("c1", "c0 + c1", n1),
                    term(f"({n0} - c0)", f"{n} - c0 - c1", n0), term(f"({n1} - c1)", f"{n} - c0 - c1", n1)])
    top = (counts.where("c0 + c1 >= 3 AND c0 + c1 < %d" % n).withColumn("g", F.expr(f"round(2 * ({g}), 6)"))
           .where(F.col("g") >= least).orderBy(F.desc("g"), "feature").limit(most))
    return {r.feature: r.c1 * n0 > r.c0 * n1 for r in top.select("feature", "c0", "c1").collect()}


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: list[float]         # ascending; empty: nothing was learnt


def _indices(features: dict[str, int], cached: int = CACHED_WORDS):
    """A function from a text to the set of its known features; most words have none."""
    known: dict[bytes, tuple[int, ...]] = {}

    def of(text: str | None) -> set[int]:
        found: set[int] = set()
        for word in set(alnum_words(text)):
            own = known.get(word)
            if own is None:
                if len(known) >= cached:
                    known.clear()
                own = known[word] = tuple(
                    i for f in word_features(word.decode()) if (i := features.get(f)) is not None)
            if own:
                found.update(own)
        return found

    return of


def cumulative_link(row: np.ndarray, column: np.ndarray, grade: np.ndarray, width: int,
                    levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of greatest penalised likelihood, by Adam.

    ``row`` and ``column`` name the ones of a 0/1 matrix. Thresholds are t_1 and
    logarithms of the steps to the following ones, which keeps them in order.
    """
    n = len(grade)
    shares = np.array([(grade >= j).mean() for j in range(1, levels + 1)]).clip(1e-4, 1 - 1e-4)
    start = np.maximum.accumulate(np.log((1 - shares) / shares) + 1e-3 * np.arange(levels))
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    w = np.zeros(width)
    first, second = np.zeros(width + levels), np.zeros(width + levels)

    def thresholds():
        return np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))

    for turn in range(1, STEPS + 1):
        s = np.bincount(row, weights=w[column], minlength=n)
        t = thresholds()
        above = np.ones((n, levels + 2))                     # P(grade >= j), j = 0 .. levels + 1
        above[:, 1:-1] = 1 / (1 + np.exp(-(s[:, None] - t[None, :]).clip(-40, 40)))
        above[:, -1] = 0
        slope = above * (1 - above)
        i = np.arange(n)
        p = np.maximum(above[i, grade] - above[i, grade + 1], 1e-12)
        pull = -(slope[i, grade] - slope[i, grade + 1]) / p
        by_threshold = np.zeros(levels)
        for j in range(1, levels + 1):
            by_threshold[j - 1] = (slope[grade == j, j] / p[grade == j]).sum() \
                - (slope[grade == j - 1, j] / p[grade == j - 1]).sum()
        tail = np.cumsum(by_threshold[::-1])[::-1]           # t_k holds every step up to k
        g_free = np.concatenate([tail[:1], tail[1:] * np.exp(free[1:])])
        g = np.concatenate([np.bincount(column, weights=pull[row], minlength=width) + L2 * w, g_free])
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        move = RATE * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
        w -= move[:width]
        free -= move[width:]
    return w, thresholds()


def fit(docs: DataFrame, labels: DataFrame, **columns) -> Model:
    rows = sample(docs, labels, **columns)
    features = screen(rows)
    if not features:
        return Model({}, [])
    place = {f: i for i, f in enumerate(features)}

    def start():
        of = _indices(place)
        return lambda texts, grade: (grade, [np.array(sorted(of(t)), np.int32).tobytes() for t in texts])

    # At most SAMPLE rows of at most FEATURES numbers each; typically a few hundred.
    made = map_columns(rows, ["text", "grade"], "grade int, ones binary", start).collect()
    made.sort(key=lambda r: (r.grade, bytes(r.ones)))        # sums do not depend on the order of tasks
    ones = [np.frombuffer(bytes(r.ones), np.int32) for r in made]
    marked = np.array(list(features.values()))
    amount = np.array([marked[o].sum() for o in ones])
    grade = np.array([r.grade for r in made])
    grade[(grade > 0) & (amount > np.median(amount[grade > 0]))] = 2
    row = np.repeat(np.arange(len(ones)), [len(o) for o in ones])
    w, t = cumulative_link(row, np.concatenate(ones), grade, len(features), int(grade.max()))
    return Model({f: float(w[i]) for f, i in place.items()}, [float(x) for x in t])


def score(docs: DataFrame, model: Model, name: str, *, text: str = "text") -> DataFrame:
    """``docs`` with the struct ``name`` (RESULT): expected severity, P(grade >= j), likeliest grade."""
    features = {f: i for i, f in enumerate(model.weights)}
    weights = np.array(list(model.weights.values()))
    thresholds = np.array(model.thresholds)

    def start():
        of = _indices(features)

        def step(texts):
            severity, at_least, grade = [], [], []
            for t in texts:
                s = weights[sorted(of(t))].sum() if len(weights) else 0.0
                p = 1 / (1 + np.exp(-(s - thresholds).clip(-40, 40)))
                severity.append(float(p.sum()))
                at_least.append(p.tolist())
                grade.append(int((p >= 0.5).sum()))
            return severity, at_least, grade

        return step

    return with_result(docs, [text], RESULT, start, name)


def toxic(name: str):
    return F.col(f"{name}.severity") >= REJECT


def rate(docs: DataFrame, labels: DataFrame, name: str | None = None) -> tuple[DataFrame, str]:
    """Fit on the labelled ones of ``docs`` and score all; also the name of the added column."""
    name = name or fresh(docs, "toxicity")
    return score(docs, fit(docs, labels), name), name
