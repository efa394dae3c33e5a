"""A small byte-level convolutional network in numpy.

A text is its UTF-8 bytes. Filters of WIDTH bytes run over every position, their
rectified responses are averaged over chunks of two blocks (CHUNK bytes, half of
which the next chunk shares), a second layer of filters reads the chunks, and
the maximum over all chunks of a text goes into one logistic unit. The second
layer also sees how many four-byte strings of the chunk's blocks are distinct, since no
filter of fixed weights can tell a word said over and over.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BLOCK = 64
CHUNK = 2 * BLOCK
WIDTH = 4
PAD = 256
# Brings the share of distinct strings, 0 to 1, to the range of the filters' means.
SHARE_SCALE = 4
# Bytes laid out at a time: what bounds memory for long texts and large batches.
BUFFER = 1 << 19


@dataclass
class Network:
    """Weights: ``taps`` (WIDTH, 257, filters), ``mix`` (filters + 1, hidden), ``out`` (hidden)."""

    taps: np.ndarray
    bias: np.ndarray
    mix: np.ndarray
    mix_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.taps, self.bias, self.mix, self.mix_bias, self.out, self.out_bias]


@dataclass
class Layout:
    """Padded bytes of some texts: ``starts`` are each text's first block, then the end."""

    data: np.ndarray
    used: np.ndarray
    starts: np.ndarray
    owners: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def untrained(filters: int, hidden: int, seed: int) -> Network:
    rng = np.random.default_rng(seed)
    taps = rng.normal(0, 0.5, (WIDTH, 257, filters)).astype(np.float32)
    taps[:, PAD] = 0
    return Network(
        taps,
        np.zeros(filters, np.float32),
        rng.normal(0, 1 / np.sqrt(filters), (filters + 1, hidden)).astype(np.float32),
        np.zeros(hidden, np.float32),
        rng.normal(0, 1 / np.sqrt(hidden), hidden).astype(np.float32),
        np.zeros(1, np.float32),
    )


def lay_out(texts: list[bytes]) -> Layout:
    """Each text padded to whole blocks, one block at least, and PAD after the last."""
    blocks = np.array([max(1, -(-len(t) // BLOCK)) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(blocks)])
    data = np.full(starts[-1] * BLOCK + WIDTH, PAD, np.int16)
    used = np.zeros(starts[-1], np.float32)
    for text, first, n in zip(texts, starts, blocks):
        data[first * BLOCK : first * BLOCK + len(text)] = np.frombuffer(text, np.uint8)
        used[first : first + n] = BLOCK
        used[first + n - 1] = len(text) - (n - 1) * BLOCK
    return Layout(data, used, starts)


def pair_tables(net: Network) -> list[np.ndarray]:
    """The filters' taps added up for every two neighbouring bytes: half as many look-ups per position."""
    return [
        np.ascontiguousarray((net.taps[k][:, None] + net.taps[k + 1][None, :]).reshape(257 * 257, -1))
        for k in range(0, WIDTH, 2)
    ]


def windows(layout: Layout, blocks: np.ndarray) -> np.ndarray:
    """Bytes of each block and the WIDTH after it; behind the last block of a text there is only PAD."""
    out = layout.data[blocks[:, None] * BLOCK + np.arange(BLOCK + WIDTH)[None, :]]
    last = np.zeros(len(layout.used), bool)
    last[layout.starts[1:] - 1] = True
    out[last[blocks], BLOCK:] = PAD
    return out


def responses(tables: list[np.ndarray], bias: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Rectified filter responses at all positions of some blocks but the WIDTH look-ahead bytes."""
    pairs = wide[:, :-1].astype(np.int64) * 257 + wide[:, 1:]
    total = tables[0].take(pairs[:, :BLOCK], axis=0, mode="clip")
    for k in range(1, len(tables)):
        total += tables[k].take(pairs[:, 2 * k : BLOCK + 2 * k], axis=0, mode="clip")
    total += bias
    np.maximum(total, 0, out=total)
    total[wide[:, :BLOCK] == PAD] = 0
    return total


def block_sums(net: Network, layout: Layout) -> np.ndarray:
    """Summed responses of each block, computed a part of the buffer at a time."""
    n, step = len(layout.used), BUFFER // 16 // BLOCK
    tables = pair_tables(net)
    parts = []
    for at in range(0, n, step):
        live = responses(tables, net.bias, windows(layout, np.arange(at, min(at + step, n))))
        parts.append(live.sum(axis=1))
    return np.concatenate(parts)


def distinct_strings(layout: Layout) -> np.ndarray:
    """How many different four-byte strings begin in each block; strings over the text's end do not count."""
    wide = windows(layout, np.arange(len(layout.used)))
    low = wide.astype(np.uint8).astype(np.uint32)
    codes = low[:, :BLOCK] << 24
    for k in range(1, 4):
        codes |= low[:, k : BLOCK + k] << (24 - 8 * k)
    absent = np.uint32(0xFFFFFFFF)  # never UTF-8
    codes[wide[:, 3 : BLOCK + 3] == PAD] = absent
    codes.sort(axis=1)
    return (1 + (codes[:, 1:] != codes[:, :-1]).sum(axis=1) - (codes[:, -1] == absent)).astype(np.float32)


def paired(values: np.ndarray, layout: Layout) -> np.ndarray:
    """Each block plus the next block of the same text."""
    total = values.copy()
    total[:-1] += values[1:]
    ends = layout.starts[1:] - 1
    total[ends] = values[ends]
    return total


def chunk_bytes(layout: Layout) -> np.ndarray:
    return paired(layout.used, layout)


def chunk_features(net: Network, layout: Layout) -> np.ndarray:
    sums = paired(block_sums(net, layout), layout)
    size = np.maximum(chunk_bytes(layout), 1)
    means = sums / size[:, None]
    share = SHARE_SCALE * (paired(distinct_strings(layout), layout) / size - 0.5)
    return np.concatenate([means, share[:, None]], axis=1).astype(np.float32)


def hidden_units(net: Network, features: np.ndarray) -> np.ndarray:
    return np.maximum(features @ net.mix + net.mix_bias, 0)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def pooled(net: Network, layout: Layout) -> np.ndarray:
    return np.maximum.reduceat(hidden_units(net, chunk_features(net, layout)), layout.starts[:-1], axis=0)


def score(net: Network, texts: list[bytes]) -> np.ndarray:
    """The probability of each text, whole; texts are laid out BUFFER bytes at a time."""
    out = np.empty(len(texts), np.float64)
    group: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        group.append(i)
        size += len(text) + BLOCK
        if size >= BUFFER or i == len(texts) - 1:
            top = pooled(net, lay_out([texts[j] for j in group]))
            out[group] = logistic(top.astype(np.float64) @ net.out + net.out_bias[0])
            group, size = [], 0
    return out


def fit(
    texts: list[bytes],
    labels: list[int],
    filters: int = 12,
    hidden: int = 16,
    steps: int = 400,
    batch: int = 48,
    rate: float = 0.02,
    seed: int = 7,
) -> Network:
    """Adam on the cross-entropy of both classes in equal shares; ``steps`` batches whatever the sample's size.

    Without any example of a class the prior alone is learned: every text gets the one class there is.
    """
    net = untrained(filters, hidden, seed)
    marks = np.asarray(labels, np.float64)
    classes = [np.flatnonzero(marks == c) for c in (0, 1)]
    if not len(classes[0]) or not len(classes[1]):
        net.out[:] = 0
        net.out_bias[:] = 4.0 if len(classes[1]) else -4.0 if len(classes[0]) else 0.0
        return net
    rng = np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(c, batch // 2) for c in classes])
        gradients = _gradients(net, [texts[i] for i in chosen], marks[chosen])
        pace = rate * 0.5 * (1 + np.cos(np.pi * step / steps)) + 1e-4
        for p, g, m, v in zip(net.parameters(), gradients, first, second):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        net.taps[:, PAD] = 0
    return net


def _gradients(net: Network, texts: list[bytes], marks: np.ndarray) -> list[np.ndarray]:
    layout = lay_out(texts)
    features = chunk_features(net, layout)
    units = hidden_units(net, features)
    starts, ends = layout.starts[:-1], layout.starts[1:]
    best = np.stack([s + units[s:e].argmax(axis=0) for s, e in zip(starts, ends)])
    top = np.take_along_axis(units, best, axis=0)
    error = (logistic(top @ net.out + net.out_bias[0]) - marks) / len(texts)
    g_out = top.T @ error + 1e-4 * net.out
    g_top = error[:, None] * net.out[None, :] * (top > 0)
    g_units = np.zeros_like(units)
    np.add.at(g_units, (best, np.arange(units.shape[1])[None, :]), g_top)
    rows = np.flatnonzero(g_units.any(axis=1))
    g_mix = features[rows].T @ g_units[rows] + 1e-4 * net.mix
    g_features = (g_units[rows] @ net.mix.T)[:, :-1] / np.maximum(chunk_bytes(layout)[rows], 1)[:, None]
    # A chunk is its block and the next of the same text.
    last = np.zeros(len(units), bool)
    last[ends - 1] = True
    g_blocks = np.zeros((len(units), net.bias.size), np.float32)
    g_blocks[rows] += g_features
    follow = rows[~last[rows]]
    g_blocks[follow + 1] += g_features[~last[rows]]
    touched = np.flatnonzero(g_blocks.any(axis=1))
    g_taps = np.zeros_like(net.taps)
    g_bias = np.zeros_like(net.bias)
    if len(touched):
        wide = windows(layout, touched)
        for k in range(net.bias.size):
            total = sum(net.taps[j][:, k].take(wide[:, j : j + BLOCK]) for j in range(WIDTH)) + net.bias[k]
            live = ((total > 0) & (wide[:, :BLOCK] != PAD)) * g_blocks[touched, k][:, None]
            g_bias[k] = live.sum()
            for j in range(WIDTH):
                g_taps[j, :, k] = np.bincount(
                    wide[:, j : j + BLOCK].ravel(), weights=live.ravel(), minlength=257
                )
    return [g_taps, g_bias, g_mix, g_units.sum(axis=0), g_out, np.array([error.sum()], np.float32)]
