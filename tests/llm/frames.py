"""Small documents that hold the awkward cases."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(90))
                    for _ in range(n))


def frame(spark, texts, ids=None, extra=False):
    """Documents of ``texts``; with ``extra``, columns whose names operators might use themselves."""
    ids = ids if ids is not None else range(len(texts))
    rows = [(i, t, None if k % 5 == 4 else "en", None if k % 7 == 6 else f"src{k % 3}", len(t or ""))
            for k, (i, t) in enumerate(zip(ids, texts))]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("fp", "result", "found", "row", "covered", "base", "clean", "rank", "chunk"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def awkward() -> list:
    """Null, empty, white space, ties, repeats, a very long text, characters outside the usual planes."""
    copy = prose(120, 1)
    return [None, "", "  \t\n ", "one", copy, copy, copy.upper(), copy + " tail", prose(60, 2) + " " + prose(70, 3),
            prose(70, 3), prose(40_000, 4), "naïve 日本語 😀  x\x00y", "a " * 300, prose(49, 5), prose(50, 5)]
