"""Re-Pair grammars: frequent pairs of neighbouring ids become new symbols, over and over.

A shard is one sequence of ids with one grammar. Rules are found in rounds. Each
counts all neighbouring pairs, gives every pair that is frequent enough a
symbol, and replaces occurrences that do not overlap, those of the more frequent
pair first. The bar falls by STEP a round down to LEAST occurrences, so the most
frequent pairs are always replaced first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .flat import lists, starts_of, values_of

# A rule takes two symbols and a length, so a pair pays from about this many occurrences on.
LEAST = 8
STEP = 8
# Rounds end when the last one made the sequence shorter by less than this part.
GAIN = 1 / 100


@dataclass
class Shard:
    """A sequence of symbols: ids below ``base`` stand for themselves, ``base + i`` for the two symbols of rule i.

    ``lengths`` says how many ids each rule stands for, so a position is found without expanding anything.
    """

    base: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    def widths(self) -> np.ndarray:
        """How many ids each symbol of the sequence stands for."""
        return _spans(self.symbols, self.lengths, self.base)


def _unlike(place: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which of the pairs at ``place`` to replace: no two neighbours, the heavier one of two that meet, runs from their start."""
    n = len(place)
    number = np.arange(n, dtype=np.int32)
    beside = place[1:] == place[:-1] + 1
    begins = np.ones(n, bool)
    begins[1:] = (weight[1:] != weight[:-1]) | ~beside
    inside = number - np.maximum.accumulate(np.where(begins, number, np.int32(0)))
    open_ = inside % 2 == 0
    chosen = open_.copy()
    meet = open_[1:] & open_[:-1] & beside
    chosen[1:] &= ~(meet & (weight[:-1] > weight[1:]))
    chosen[:-1] &= ~(meet & (weight[1:] > weight[:-1]))
    return chosen


def _codes(symbols: np.ndarray, top: int) -> np.ndarray:
    """Each pair of neighbours as one number, a symbol in each half; symbols are below ``top``."""
    if top <= 1 << 16:
        return (symbols[:-1] << np.uint32(16)) | symbols[1:]
    return (symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:]


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes, how often each occurs)."""
    met = np.sort(codes)
    last = np.append(np.flatnonzero(met[1:] != met[:-1]), len(met) - 1)
    return met[last], np.diff(last, prepend=-1)


def _hashed(codes: np.ndarray) -> np.ndarray:
    """16 bits of each code."""
    kind = codes.dtype.type
    return (codes * kind(0x9E3779B1)) >> kind(16) & kind(0xFFFF)


def _occurrences(codes: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where codes are among ``some``, which one is there): those of another hash are left out before looking up."""
    seen = np.zeros(1 << 16, bool)
    seen[_hashed(some)] = True
    place = np.flatnonzero(seen[_hashed(codes)])
    found = pc.index_in(pa.array(codes[place]), value_set=pa.array(some))
    return place[found.is_valid().to_numpy(zero_copy_only=False)], found.drop_null().to_numpy()


def _by_first(pair: np.ndarray, number: int) -> np.ndarray:
    """The numbers below ``number``, all of which are in ``pair``, in the order in which they first come there."""
    first = np.zeros(number, np.int64)
    first[pair[::-1]] = np.arange(len(pair))[::-1]
    return np.argsort(first)


def compress(ids: np.ndarray, base: int, least: int = LEAST) -> Shard:
    """The grammar of ``ids``, all of which are below ``base``."""
    symbols = ids.astype(np.uint32)
    left, right, lengths = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    bar = None
    while len(symbols) > 1:
        codes = _codes(symbols, base + len(left))
        known, counts = _counted(codes)
        most = int(counts.max())
        if most < least:
            break
        bar = max(least, min(most, bar or most) // STEP)
        frequent = counts >= bar
        known, counts = known[frequent], counts[frequent]
        place, pair = _occurrences(codes, known)
        order = _by_first(pair, len(known))
        weight = np.zeros(len(known), np.int32)
        weight[order[np.argsort(counts[order], kind="stable")]] = np.arange(1, len(known) + 1)
        chosen = _unlike(place, weight[pair])
        place, pair = place[chosen], pair[chosen]
        worth = np.bincount(pair, minlength=len(known)) >= max(2, least // 2)
        rules = order[worth[order]]
        if not len(rules):
            if bar == least:
                break
            continue
        chosen = worth[pair]
        place, pair = place[chosen], pair[chosen]
        symbol = np.zeros(len(known), np.uint32)
        symbol[rules] = base + len(left) + np.arange(len(rules))
        half = known.dtype.type(known.itemsize * 4)
        lefts, rights = known[rules] >> half, known[rules] & known.dtype.type((1 << int(half)) - 1)
        lengths = np.concatenate([lengths, _spans(lefts, lengths, base) + _spans(rights, lengths, base)])
        left, right = np.concatenate([left, lefts.astype(np.int64)]), np.concatenate([right, rights.astype(np.int64)])
        before = len(symbols)
        symbols[place] = symbol[pair]
        kept = np.ones(before, bool)
        kept[place + 1] = False
        symbols = symbols[kept]
        if bar == least and before - len(symbols) < before * GAIN:
            break
    return Shard(base, left, right, lengths, symbols)


def _spans(symbols: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """How many ids each symbol stands for."""
    return np.concatenate([[1], lengths])[np.maximum(symbols.astype(np.int64) - base + 1, 0)]


def _expansions(shard: Shard) -> np.ndarray:
    """The ids of every rule, end to end: all rules are replaced by their two symbols until none is left."""
    out = np.arange(len(shard.left)) + shard.base
    while (rule := out >= shard.base).any():
        at = starts_of(1 + rule)[:-1][rule]
        which = out[rule] - shard.base
        out = np.repeat(out, 1 + rule)
        out[at], out[at + 1] = shard.left[which], shard.right[which]
    return out


def _expanded(shard: Shard, symbols: np.ndarray) -> np.ndarray:
    table = np.concatenate([np.arange(shard.base, dtype=np.uint32), _expansions(shard).astype(np.uint32)])
    bounds = np.concatenate([np.arange(shard.base), shard.base + starts_of(shard.lengths)])
    return values_of(lists(table, bounds).take(pa.array(symbols)))[0]


def ids_of(shard: Shard) -> np.ndarray:
    """All ids of the shard."""
    return _expanded(shard, shard.symbols)


def ids_between(shard: Shard, start: int, end: int) -> np.ndarray:
    """The ids from ``start`` up to ``end``: only symbols that stand for some of them are expanded."""
    if end <= start:
        return np.zeros(0, np.uint32)
    widths = shard.widths()
    ends = np.cumsum(widths)
    first, last = np.searchsorted(ends, [start, end - 1], "right")
    found = _expanded(shard, shard.symbols[first : last + 1])
    before = int(ends[first] - widths[first])
    return found[start - before : end - before]


def pack(shard: Shard) -> bytes:
    """The shard as bytes, little-endian; symbols take two bytes where all fit, else four."""
    wide = 2 if shard.base + len(shard.left) <= 1 << 16 else 4
    head = np.array([shard.base, len(shard.left), len(shard.symbols), wide], "<u4").tobytes()
    kind = f"<u{wide}"
    return head + b"".join(
        [shard.left.astype(kind).tobytes(), shard.right.astype(kind).tobytes()]
        + [shard.lengths.astype("<u4").tobytes(), shard.symbols.astype(kind).tobytes()]
    )


def unpack(data: bytes | memoryview) -> Shard:
    base, rules, size, wide = np.frombuffer(data, "<u4", 4).tolist()
    kind, at = f"<u{wide}", 16
    left = np.frombuffer(data, kind, rules, at)
    right = np.frombuffer(data, kind, rules, at + rules * wide)
    lengths = np.frombuffer(data, "<u4", rules, at + 2 * rules * wide)
    symbols = np.frombuffer(data, kind, size, at + 2 * rules * wide + 4 * rules)
    return Shard(base, left.astype(np.int64), right.astype(np.int64), lengths.astype(np.int64), symbols)
