"""Secret scans: fixed patterns, and a battery of randomness tests on long tokens.

Patterns give spans of kinds assign, access and hex. Beside them every run of 20 or
more token characters with a letter is a candidate. Its encoding is
inferred from its characters, which maps them to numbers below the alphabet's size;
four tests ask whether these could be drawn at random: chi-squared uniformity over
the alphabet, the shares of capitals, small letters and other characters, runs above
and below the alphabet's middle, and serial correlation. The smallest of their
p-values, times four, is the candidate's p-value.

A run that no alphabet can spell is cut into its pieces of either 64-letter alphabet,
each a candidate from 20 characters on. Pieces of the two alphabets may overlap.

Length decides how much a test can see, so false discoveries are controlled within
bands of length (powers of two): the Benjamini-Hochberg rule over all distinct
candidates of a band says which are not random; the others are spans of kind random.
The discoveries are thus the tokens set aside as written: of these at most ``RATE`` are
random in expectation, which bounds the secrets that are lost. How many written tokens
pass as random is not bounded by the rule; tests measure both at several shares.
A token counts once, however often it is copied. Spans of the fixed patterns stay
whatever the tests say.

Built from DataFrame and SQL functions only. Positions are code points.

Defined results: a null or empty text has no spans; repeated rows are scanned each;
without candidates nothing is added.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import fresh
from tessera.operators.ranks import positions
from tessera.session import materialize

# The patterns, in the order in which kinds are listed. Where only the
# length of a greedy run decides, the length stands in the pattern: same matches.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ["assign", "access", "hex", "random"]
LEAST_VALUE = 8

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
# Pieces of a run with characters of both: of the standard and of the URL-safe 64-letter alphabet.
PIECES = [r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{20,}+={0,2}", r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+={0,2}"]
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Alphabets from narrow to wide, each with the pattern of tokens it can spell.
ENCODINGS = [
    ("^[0-9a-f]+$", DIGITS + "abcdef"),
    ("^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("^[A-Z2-7]+=*$", UPPER + "234567"),
    ("^[0-9a-z]+$", DIGITS + LOWER),
    ("^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    ("^[0-9A-Za-z+/]+=*$", UPPER + LOWER + DIGITS + "+/"),
    ("^[0-9A-Za-z_-]+=*$", UPPER + LOWER + DIGITS + "-_"),
]
RATE = 0.05         # of false discoveries
LONGEST_BAND = 12

MARK, OTHER = "\ue000", "\ue001"       # private characters: cut marks, and what stands for them in a text
SCAN_BLOCK = 256
REDACTED = "[SECRET]"


def running_starts(lengths: Column) -> Column:
    """Sums of the elements before each element, in blocks so that long arrays stay cheap."""
    zero = F.array(F.lit(0).cast("long"))
    add = lambda sums, x: F.array_append(sums, F.element_at(sums, -1) + x)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / SCAN_BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(lengths, b * SCAN_BLOCK + 1, F.lit(SCAN_BLOCK)), zero, add))
    bases = F.aggregate(blocks, zero, lambda sums, b: add(sums, F.element_at(b, -1)))
    return F.flatten(F.transform(blocks, lambda block, i: F.transform(
        F.slice(block, F.lit(1), F.size(block) - 1), lambda x: x + F.element_at(bases, i + 1))))


def with_matches(df: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """Column ``name``: leftmost non-overlapping matches as array of (start, end, found).

    Matches are enclosed in marks and the text is cut there: every second piece is a
    match, and the lengths of the pieces before give its place. ``text`` holds no marks.
    """
    pieces = fresh(df, "pieces")
    cut = df.withColumn(pieces, F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1))
    lengths = F.transform(pieces, lambda p: F.length(p).cast("long"))
    placed = F.transform(F.arrays_zip(F.col(pieces).alias("found"), running_starts(lengths).alias("start")),
                         lambda x, i: F.struct(x.start.alias("start"), (x.start + F.length(x.found)).alias("end"),
                                               x.found.alias("found"), (i % 2).alias("odd")))
    spans = F.transform(F.filter(placed, lambda x: x.odd == 1),
                        lambda x: F.struct(x.start.alias("start"), x.end.alias("end"), x.found.alias("found")))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,found:string>>")
    return cut.withColumn(name, F.when(F.size(pieces) > 1, spans).otherwise(empty)).drop(pieces)


def upper_tail(z: Column) -> Column:
    """P(normal > z), to four digits."""
    z = F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.070566 * z * z * z))


def p_random(token: Column) -> Column:
    """p-value of the battery under the hypothesis that the token is drawn at random; null: no encoding."""
    def battery(alphabet: str) -> Column:
        k = len(alphabet)
        body = F.regexp_replace(token, "=+$", "") if "2" in alphabet else token
        n = F.length(body).cast("double")
        occurs = F.transform(F.array(*map(F.lit, alphabet)),
                             lambda c: (n - F.length(F.replace(body, c, F.lit("")))).cast("double"))
        chi = F.aggregate(occurs, F.lit(0.0), lambda s, c: s + c * c) * k / n - n
        z_chi = (chi - (k - 1)) / F.sqrt(2.0 * (k - 1) * (n - 1) / n)

        shares = []
        for own in ("[^A-Z]", "[^a-z]", "[A-Za-z]"):
            share = len(re.sub(own, "", alphabet)) / k
            if share:
                found = F.length(F.regexp_replace(body, own, "")).cast("double")
                shares.append((found - n * share) * (found - n * share) / (n * share))
        distance = sum(shares[1:], shares[0])
        # Of three classes the tail is exact; two have one degree of freedom.
        p_class = F.exp(-distance / 2) if len(shares) == 3 else 2 * upper_tail(F.sqrt(distance))

        halves = F.translate(body, alphabet, "0" * (k // 2) + "1" * (k - k // 2))
        n0 = F.length(F.replace(halves, F.lit("1"), F.lit(""))).cast("double")
        n1 = n - n0
        changes = sum((n - F.length(F.replace(halves, F.lit(x), F.lit("")))) / 2 for x in ("01", "10"))
        expected = 2 * n0 * n1 / n
        spread = F.sqrt(F.greatest(expected * (expected - 1) / (n - 1), F.lit(1e-9)))
        # All above or all below: as far from random as it gets.
        z_runs = F.when((n0 == 0) | (n1 == 0), 8.0).otherwise(F.abs(changes - expected) / spread)

        values = F.transform(F.split(body, ""), lambda c: F.instr(F.lit(alphabet), c).cast("double"))
        mean = F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / n
        near = F.transform(values, lambda x: x - mean)
        square = F.aggregate(near, F.lit(0.0), lambda s, x: s + x * x)
        lagged = F.aggregate(
            F.zip_with(F.slice(near, F.lit(1), F.size(near) - 1), F.slice(near, F.lit(2), F.size(near) - 1),
                       lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        z_serial = F.when(square == 0, 8.0).otherwise(F.abs(lagged / square + 1 / n) * F.sqrt(n))
        return F.least(F.lit(1.0), 4 * F.least(
            upper_tail(z_chi), p_class, 2 * upper_tail(z_runs), 2 * upper_tail(z_serial)))

    chosen = None
    for pattern, alphabet in ENCODINGS:
        fits = token.rlike(pattern)
        chosen = F.when(fits, battery(alphabet)) if chosen is None else chosen.when(fits, battery(alphabet))
    return F.when(token.rlike("[A-Za-z]"), chosen)


def scan(docs: DataFrame, base: str, candidates: str, *, text: str = "text") -> DataFrame:
    """``docs`` with ``base``: spans (start, end, kind) of the patterns, and ``candidates``: tested tokens."""
    clean, a, b, c, d, cut, e, f = (fresh(docs, x) for x in (
        "clean", "assign", "access", "hex", "tokens", "cut", "standard", "url_safe"))
    df = docs.withColumn(clean, F.translate(F.coalesce(F.col(text), F.lit("")), MARK, OTHER))
    for pattern, name in ((ASSIGN, a), (ACCESS, b), (HEX, c), (CANDIDATE, d)):
        df = with_matches(df, clean, pattern, name)
    unspelt = lambda x: x.found.rlike("[+/]") & x.found.rlike("[_-]")
    df = df.withColumn(cut, F.when(F.exists(d, unspelt), F.col(clean)).otherwise(""))
    for pattern, name in zip(PIECES, (e, f)):
        df = with_matches(df, cut, pattern, name)
    # Every piece lies in one run.
    pieces = F.filter(F.concat(e, f), lambda x: F.exists(
        F.filter(d, unspelt), lambda t: (t.start <= x.start) & (x.end <= t.end)))
    tokens = F.concat(F.filter(d, lambda x: ~unspelt(x)), F.when(F.exists(d, unspelt), pieces).otherwise(
        F.array().cast("array<struct<start:bigint,end:bigint,found:string>>")))
    of_kind = lambda column, kind: F.transform(column, lambda x: F.struct(
        x.start.alias("start"), x.end.alias("end"), F.lit(kind).alias("kind")))
    long_enough = F.filter(a, lambda x: F.length(F.regexp_extract(x.found, ASSIGN, 2)) >= LEAST_VALUE)
    df = df.withColumn(base, F.array_sort(F.flatten(F.array(
        *(of_kind(column, str(i)) for i, column in enumerate((long_enough, b, c)))))))
    # Sorted by start, end and kind; what counts is start, then kind.
    df = df.withColumn(base, F.transform(
        F.array_sort(F.transform(base, lambda x: F.struct(x.start, x.kind, x.end))),
        lambda x: F.struct(x.start.alias("start"), x.end.alias("end"),
                           F.element_at(F.array(*map(F.lit, KINDS)), x.kind.cast("int") + 1).alias("kind"))))
    new = F.filter(tokens, lambda t: ~F.exists(base, lambda x: (x.start < t.end) & (t.start < x.end)))
    tested = F.filter(
        F.transform(new, lambda t: F.struct(
            t.start.alias("start"), t.end.alias("end"), F.xxhash64(t.found).alias("token"), p_random(t.found).alias("p"),
            F.least(F.floor(F.log2(t.end - t.start)), F.lit(LONGEST_BAND)).cast("int").alias("band"))),
        lambda t: t.p.isNotNull())
    return df.withColumn(candidates, tested).drop(clean, a, b, c, d, cut, e, f)


def thresholds(scanned: DataFrame, candidates: str) -> dict[int, float]:
    """By band of length the p-value up to which candidates are not random.

    Benjamini-Hochberg over the distinct tokens of a band: the largest p-value with
    p * tokens <= RATE * (tokens up to p). The tokens up to each p-value are counted by distributed
    running sums; the driver sees one row per band.
    """
    tokens = materialize(
        scanned.select(F.explode(candidates).alias("c")).select("c.band", "c.token", "c.p").distinct(), "tokens")
    sizes = sorted((r.band, r["count"]) for r in tokens.groupBy("band").count().collect())
    if not sizes:
        return {}
    found = positions(tokens.select("band", "p"), ["band", "p"])[0]
    whole, before, ahead = F.lit(0), F.lit(0), 0
    for band, size in sizes:
        whole = F.when(F.col("band") == band, size).otherwise(whole)
        before = F.when(F.col("band") == band, ahead).otherwise(before)
        ahead += size
    upto = F.col("_before") + F.col("_here") - before
    kept = found.where(F.col("p") * whole <= RATE * upto).groupBy("band").agg(F.max("p").alias("p"))
    return {r.band: r.p for r in kept.collect()}


def with_spans(scanned: DataFrame, base: str, candidates: str, name: str) -> DataFrame:
    """``scanned`` (written) with ``name``: all spans (start, end, kind), by start, then kind as listed."""
    limits = thresholds(scanned, candidates)

    def certain(c: Column) -> Column:
        reject = F.lit(False)
        for band, t in limits.items():
            reject = reject | ((c.band == band) & (c.p <= t))
        return reject

    added = F.transform(F.filter(candidates, lambda c: ~certain(c)), lambda c: F.struct(
        c.start.alias("start"), c.end.alias("end"), F.lit(KINDS[-1]).alias("kind")))
    # Added spans overlap no base span, so that sorting by start keeps the listed order of kinds:
    # base spans of one start are numbered by their place.
    every = F.concat(F.transform(base, lambda x, i: F.struct(x.start, i.alias("i"), x.end, x.kind)),
                     F.transform(added, lambda x, i: F.struct(x.start, i.alias("i"), x.end, x.kind)))
    return scanned.withColumn(name, F.transform(F.array_sort(every), lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))


def find_secrets(docs: DataFrame, keep: list[str], *, text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, with ``base`` and ``spans``."""
    scanned = materialize(scan(docs, "base", "candidates", text=text).select(*keep, "base", "candidates"), "secrets")
    return with_spans(scanned, "base", "candidates", "spans").drop("candidates")


def listed(spans: Column | str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")


def redact(docs: DataFrame, *, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced by a fixed word; same columns, lengths kept true."""
    base, candidates, spans, out = (fresh(docs, x) for x in ("base", "candidates", "spans", "out"))
    scanned = materialize(scan(docs, base, candidates, text=text), "secrets")
    found = with_spans(scanned, base, candidates, spans)
    # Overlapping spans are walked through once: (place reached, pieces so far).
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("pieces"))
    piece = lambda at, end: F.substring(F.col(text), (at + 1).cast("int"), (end - at).cast("int"))
    walked = F.aggregate(spans, start, lambda acc, x: F.struct(
        F.greatest(acc.at, x.end).alias("at"),
        F.when(x.start >= acc.at, F.concat(acc.pieces, F.array(piece(acc.at, x.start), F.lit(REDACTED))))
        .otherwise(acc.pieces).alias("pieces")))
    found = found.withColumn(out, F.when(F.size(spans) > 0, walked))
    cleaned = F.when(F.size(spans) > 0, F.concat(
        F.array_join(f"{out}.pieces", ""),
        F.substring(F.col(text), (F.col(f"{out}.at") + 1).cast("int"), F.length(text)))).otherwise(F.col(text))
    found = found.withColumn(text, cleaned)
    if n_chars in docs.columns:
        found = found.withColumn(n_chars, F.when(F.size(spans) > 0, F.length(text).cast(docs.schema[n_chars].dataType))
                                 .otherwise(F.col(n_chars)))
    return found.select(*docs.columns)
