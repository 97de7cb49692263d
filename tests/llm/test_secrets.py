"""The randomness battery and its false-discovery control against brute force."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import secrets
from tests.llm.frames import frame, prose

BASE62 = secrets.DIGITS + secrets.UPPER + secrets.LOWER


def plain_p(token):
    """The battery, character by character."""
    alphabet = next((a for p, a in secrets.ENCODINGS if re.match(p, token)), None)
    if alphabet is None or not re.search("[A-Za-z]", token):
        return None
    body = re.sub("=+$", "", token) if "2" in alphabet else token
    n, k = len(body), len(alphabet)

    def tail(z):
        z = max(min(z, 8.0), -8.0)
        return 1 / (1 + math.exp(1.5976 * z + 0.070566 * z ** 3))

    chi = sum((body.count(c) - n / k) ** 2 for c in alphabet) * k / n
    z_chi = (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    distance, classes = 0.0, 0
    for own in (str.isupper, str.islower, lambda c: not c.isalpha()):
        share = sum(map(own, alphabet)) / k
        if share:
            distance += (sum(map(own, body)) - n * share) ** 2 / (n * share)
            classes += 1
    p_class = math.exp(-distance / 2) if classes == 3 else 2 * tail(math.sqrt(distance))
    high = [alphabet.index(c) >= k // 2 for c in body]
    n1, changes = sum(high), sum(a != b for a, b in zip(high, high[1:]))
    n0 = n - n1
    expected = 2 * n0 * n1 / n
    spread = math.sqrt(max(expected * (expected - 1) / (n - 1), 1e-9))
    z_runs = 8.0 if not n0 or not n1 else abs(changes - expected) / spread
    values = [alphabet.index(c) for c in body]
    mean = sum(values) / n
    near = [v - mean for v in values]
    square = sum(x * x for x in near)
    z_serial = 8.0 if not square else abs(sum(a * b for a, b in zip(near, near[1:])) / square + 1 / n) * math.sqrt(n)
    return min(1.0, 4 * min(tail(z_chi), p_class, 2 * tail(z_runs), 2 * tail(z_serial)))


def tokens(n, seed, alphabet=BASE62, low=24, high=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(low, high))) for _ in range(n)]


def written(n, seed):
    rng = random.Random(seed)
    stock = "customer order payload service adapter factory request handler session config manager value string".split()
    return ["".join(w.capitalize() for w in rng.choices(stock, k=rng.randrange(3, 7))) for _ in range(n)]


def test_battery_equals_brute_force(spark):
    every = (tokens(60, 1) + tokens(30, 2, "0123456789abcdef") + tokens(30, 3, secrets.UPPER + "234567") + written(40, 4)
             + [t + "==" for t in tokens(10, 5, BASE62 + "+/")] + ["a" * 30, "ab" * 15, "A" * 20, "aB3" * 9, "1" * 25])
    df = spark.createDataFrame([(t,) for t in every], "t string").withColumn("p", secrets.p_random(F.col("t")))
    for r in df.collect():
        want = plain_p(r.t)
        assert (r.p is None) == (want is None), r.t
        assert want is None or r.p == pytest.approx(want, rel=1e-9, abs=1e-15), r.t


def plain_limits(found):
    """Benjamini-Hochberg by sorting; ``found``: (band, token, p)."""
    out = {}
    for band in {b for b, _, _ in found}:
        own = sorted({(t, p) for b, t, p in found if b == band}, key=lambda x: x[1])
        ok = [p for k, (_, p) in enumerate(own, 1) if p * len(own) <= secrets.RATE * sum(q <= p for _, q in own)]
        if ok:
            out[band] = max(ok)
    return out


def test_thresholds_equal_sorting(spark):
    texts = [" ".join(tokens(12, 30 + k) + written(9, 60 + k) + [written(1, 7)[0]] * (k % 5)) for k in range(25)]
    scanned = secrets.scan(frame(spark, texts), "base", "candidates")
    found = [(c.band, c.token, c.p) for r in scanned.collect() for c in r.candidates]
    assert secrets.thresholds(scanned, "candidates") == plain_limits(found) != {}
    assert secrets.thresholds(scanned.where("false"), "candidates") == {}


def _reported(spark, texts):
    out = set()
    for r in secrets.find_secrets(frame(spark, texts), ["doc_id"]).collect():
        out |= {texts[r.doc_id][s.start:s.end] for s in r.spans if s.kind == "random"}
    return out


def test_copies_of_a_written_token_move_nothing(spark):
    own = tokens(300, 21, low=32, high=60)
    texts = [" ".join(own[k::20]) + " " + prose(9, k) for k in range(20)]
    word = "CustomerOrderPayloadServiceAdapterFactory"
    plain, copied = _reported(spark, [*texts, word]), _reported(spark, [*texts, *[word] * 500])
    assert plain == copied and word not in copied and len(plain) >= 0.97 * len(own)


@pytest.mark.parametrize("share", [0.1, 0.5, 0.9])
def test_recall_and_false_reports_by_share_of_written_tokens(spark, share):
    """The bound of the rule: random tokens lost are at most RATE of those set aside, give or take chance."""
    n = 600
    names, own = sorted(set(written(int(n * share * 2), 8)))[: int(n * share)], tokens(int(n * (1 - share)), 9, low=32, high=60)
    every = names + own
    random.Random(3).shuffle(every)
    found = _reported(spark, [" ".join(every[k::30]) for k in range(30)])
    lost, wrong = len(set(own) - found), len(set(names) & found)
    aside = len(every) - len(found & set(every))
    assert lost <= 2 * secrets.RATE * aside + 3
    assert wrong <= 0.05 * len(names) + 3
