"""Best-fit packing by a configuration linear program over the length histogram.

1. Documents become pieces of at most ``CAPACITY`` tokens.
2. The histogram of piece lengths (at most ``CAPACITY`` numbers) defines a covering
   program: configurations are multisets of lengths that fit one sequence, and few
   of them shall cover every length as often as it occurs. Multiplicative weights
   price the lengths, a knapsack dynamic program finds the best configuration.
3. The fractional answer is rounded down; what remains is filled by knapsack at prices
   equal to room, longest length first, each configuration as often as it fits.
4. Every piece finds its place from its rank among the pieces of its length.

Steps 2 and 3 handle counts only: their work does not grow with the pieces.

Defined results: a null or empty text is one piece holding the end token; rows are
packed one by one, repeated or not; no documents, no sequences.
"""

from __future__ import annotations

import json
import re
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import gapless, map_columns
from tessera.session import materialize

CAPACITY = 1024
END = 2                 # token closing each document
ROUNDS = 400            # of multiplicative weights
STEP = 0.02             # of the logarithm of a price, for a length covered once
FEE = 0.05              # price of a piece beside its room
CACHED_WORDS = 600_000  # pre-tokens whose ids a task remembers

# The published pre-token pattern of the byte-level vocabulary, spelt out
# for texts of the characters below, on which all pattern engines agree. Texts with
# other characters are given to the tokenizer whole.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
PRE_TOKEN = re.compile(
    rf" ?[{LETTERS}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
COMMON = re.compile(r"[\t\n\x20-\x7e¡-¬®-±´-¸º»¿-ɏ‐-‧‰-⁞]*+")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Tokens(dict):
    """Ids of texts as little-endian unsigned 32-bit numbers.

    A byte-level tokenizer cuts a text into pre-tokens and encodes each alone, so the
    ids of a pre-token are remembered (in this dictionary). Where the vocabulary's
    numbers follow its merges, a single pre-token is encoded by a library made for
    that; otherwise by the tokenizer itself.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark has given this task one core
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.single = _single_encoder(path) or self._whole

    @classmethod
    def of_worker(cls, path: str) -> "Tokens":
        """The one of this Python worker, which outlives its tasks."""
        import tokenizers

        held = tokenizers.__dict__.setdefault("_tessera_tokens", {})
        if path not in held:
            held[path] = cls(path)
        return held[path]

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        ids = self.single(word)
        self[word] = made = struct.pack(f"<{len(ids)}I", *ids)
        return made

    def ids(self, text: str) -> bytes:
        if COMMON.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.__getitem__, PRE_TOKEN.findall(text)))
        return np.array(self._whole(text), "<u4").tobytes()


def _single_encoder(path: str):
    """Encodes one pre-token; None if the file is no byte-level BPE numbered by its merges."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    # Byte-level vocabularies write printable Latin-1 as itself, other bytes from 256 on.
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
    vocabulary = model["vocab"]
    if any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if i < 256 + len(merges)}
    return tiktoken.Encoding("pieces", pat_str=".", mergeable_ranks=ranks, special_tokens={})._encode_single_piece


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces: full ones, only the first may be shorter."""
    n = len(ids) // 4
    first = n % capacity or capacity
    edges = [0, *range(first, n + 1, capacity)]
    return [(a, b - a, zlib.crc32(ids[4 * a:4 * b])) for a, b in zip(edges, edges[1:])]


def pieces(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The pieces (PIECES) of all documents."""
    last = np.array([end], "<u4").tobytes()

    def start():
        tokens = Tokens.of_worker(tokenizer)

        def step(ids, texts):
            rows = [(doc, i, *piece) for doc, t in zip(ids, texts)
                    for i, piece in enumerate(cut(tokens.ids(t or "") + last, capacity))]
            return [list(column) for column in zip(*rows)] or [[]] * 5

        return step

    return map_columns(docs, [doc_id, text], PIECES, start)


def knapsack(prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value for each room 0 .. capacity, and the length taken last (0: none).

    ``prices[l]`` is the price of length l, 0 where l does not occur.
    """
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    lengths = np.flatnonzero(prices > 0)
    value = prices[lengths]
    for room in range(1, capacity + 1):
        fit = np.searchsorted(lengths, room, "right")
        best[room] = best[room - 1]
        if fit:
            total = value[:fit] + best[room - lengths[:fit]]
            k = int(total.argmax())
            if total[k] > best[room] + 1e-15:
                best[room], taken[room] = total[k], lengths[k]
    return best, taken


def contents(taken: np.ndarray, room: int) -> dict[int, int]:
    """The configuration behind an entry of the knapsack table: copies by length."""
    config: dict[int, int] = {}
    while room > 0:
        length = int(taken[room])
        if length:
            config[length] = config.get(length, 0) + 1
            room -= length
        else:
            room -= 1
    return config


def fractional(demand: np.ndarray, capacity: int, rounds: int) -> list[tuple[dict, float]]:
    """Configurations with (fractional) numbers of uses.

    Each round uses the configuration of most value; a length's price falls with
    the share of its demand covered so far.
    """
    lengths = np.flatnonzero(demand)
    cover = np.zeros(capacity + 1)
    # Prices start at the room a length takes, less a fee for each piece: of equally full
    # configurations one of few, long pieces is taken, and short ones stay to fill gaps.
    log_price = np.full(capacity + 1, -np.inf)
    log_price[lengths] = np.log((lengths - FEE) / capacity)
    uses: dict[tuple, float] = {}
    for k in range(rounds):
        prices = np.exp(log_price - log_price[lengths].max())
        _, taken = knapsack(prices, capacity)
        config = contents(taken, capacity)
        # As often as covers its scarcest length by one step of the rounds.
        often = min(demand[l] / c for l, c in config.items())
        key = tuple(sorted(config.items(), reverse=True))
        uses[key] = uses.get(key, 0.0) + often
        for l, c in config.items():
            gain = c * often / demand[l]
            cover[l] += gain
            log_price[l] -= STEP * gain
    # Scaled to cover no length more often than it occurs: rounding down then holds.
    scale = float(cover[lengths].max())
    return [(dict(key), count / scale) for key, count in uses.items()]


def plan(demand: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """Configurations and whole numbers of uses that hold every piece exactly once."""
    left = demand.astype(np.int64).copy()
    out: list[tuple[dict[int, int], int]] = []

    def use(config: dict[int, int], often: int) -> None:
        if often > 0:
            out.append((config, often))
            for l, c in config.items():
                left[l] -= c * often

    full = int(left[capacity])
    use({capacity: 1}, full)
    if not left.any():
        return out
    # A length's room is a price vector no packing can beat (total room / capacity), so only
    # full configurations can belong to the best answer: those of the program are used,
    # the demand of the others is filled below.
    for config, often in fractional(left, capacity, rounds):
        if sum(l * c for l, c in config.items()) == capacity:
            use(config, int(often))
    while left.any():
        use(*_next(left, capacity))
    return out


def _next(left: np.ndarray, capacity: int) -> tuple[dict[int, int], int]:
    """The longest length left with the fullest completion, as often as it fits.

    The knapsack does not know how often a length is left, so what it asks for beyond
    that is replaced by the longest lengths that still fit (best fit).
    """
    longest = int(np.flatnonzero(left)[-1])
    config = {longest: 1}
    room = capacity - longest
    prices = np.where(left > 0, np.arange(len(left)), 0).astype(float)
    prices[longest] = longest if left[longest] > 1 else 0
    prices[prices > 0] -= FEE
    if room:
        _, taken = knapsack(prices[:room + 1], room)
        for length, count in sorted(contents(taken, room).items(), reverse=True):
            fits = min(count, int(left[length]) - config.get(length, 0))
            if fits > 0:
                config[length] = config.get(length, 0) + fits
                room -= fits * length
    while room:
        fitting = [l for l in np.flatnonzero(left[:room + 1])[::-1] if left[l] > config.get(int(l), 0)]
        if not fitting:
            break
        length = int(fitting[0])
        config[length] = config.get(length, 0) + 1
        room -= length
    return config, min(int(left[l]) // c for l, c in config.items())


def layout(configs: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first ranks, uses, first sequence and offset of each place that takes it.

    A configuration with c copies of a length, used m times, takes c runs of m
    ranks; run t puts its j-th piece into the j-th of the m sequences.
    """
    places: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for config, often in configs:
        offset = 0
        for length, copies in sorted(config.items(), reverse=True):
            for _ in range(copies):
                rank = ranks.get(length, 0)
                places.setdefault(length, []).append((rank, sequence, offset))
                ranks[length] = rank + often
                offset += length
        sequence += often
    return {l: tuple(np.array(c, np.int64) for c in zip(*rows)) for l, rows in places.items()}


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, rounds: int = ROUNDS,
         **columns) -> DataFrame:
    """All pieces with ``sequence_id`` and ``offset``."""
    made = materialize(pieces(docs, tokenizer, capacity=capacity, **columns), "pieces")
    demand = np.zeros(capacity + 1, np.int64)
    for length, count in made.groupBy("length").count().collect():       # at most ``capacity`` rows
        demand[length] = count
    if not demand.any():
        return made.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    places = layout(plan(demand, capacity, rounds))

    def start():
        def step(*columns):
            length = np.array(columns[3], np.int64)
            rank = np.array(columns[5], np.int64)
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for l in np.unique(length):
                own = length == l
                first, base, at = places[int(l)]
                run = np.searchsorted(first, rank[own], "right") - 1
                sequence[own] = base[run] + rank[own] - first[run]
                offset[own] = at[run]
            return *columns[:5], sequence, offset

        return step

    ranked = gapless(made, ["length"], ["doc_id", "piece", "ids_crc32"], "rank")
    return map_columns(ranked, ["doc_id", "piece", "start", "length", "ids_crc32", "rank"],
                       f"{PIECES}, sequence_id long, offset long", start)
