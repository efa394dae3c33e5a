"""Plain-Python versions of the operators, written from their definitions, for tests on small tables."""

import base64
import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

BLANKS = r"[^\x20\x09-\x0D]+"


def rule_counts(text):
    text = text or ""
    words = re.findall(BLANKS, text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(8)}
    lines = [line for line in text.split("\n") if re.search(BLANKS, line)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def secret_spans(text):
    text = text or ""
    found = []
    keyword = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in
                       ("password", "passwd", "secret", "token"))
    keyword += "|[aA][pP][iI]_?[kK][eE][yY]"
    rules = [
        (rf"({keyword})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12, "assign"),
        (r"AKIA[A-Z0-9]+", 0, 18, "access"),
        (r"[0-9a-f]+", 0, 16, "hex"),
    ]
    for place, (pattern, group, least, kind) in enumerate(rules):
        for m in re.finditer(pattern, text):
            if len(m.group(group)) >= least:
                found.append((m.start(), place, kind, m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def fingerprint(text):
    words = re.findall(BLANKS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(rows, radius=4):
    """[(doc_id, fingerprint, component)] by comparing every two fingerprints."""
    prints = [(i, fingerprint(t)) for i, t in rows]
    values = sorted({p for _, p in prints})
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    lowest = {}
    for i, p in prints:
        if i is not None:
            lowest[root(p)] = min(i, lowest.get(root(p), i))
    return [(i, p, lowest.get(root(p))) for i, p in prints]


def line_dedup(rows, ratio=0.1, least=5):
    """[(doc_id, host, text)] to [(doc_id, text, n_lines, n_dropped)]."""
    trim = lambda line: line.strip(" \t\r")
    pages, total = Counter(), Counter()
    for _, host, text in rows:
        if host is not None:
            total[host] += 1
            pages.update((host, line) for line in {trim(x) for x in (text or "").split("\n")} - {""})
    out = []
    for i, host, text in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines = text.split("\n")
        bad = [
            host is not None and trim(x) != "" and pages[host, trim(x)] >= least
            and pages[host, trim(x)] > ratio * total[host]
            for x in lines
        ]
        kept = [x for x, b in zip(lines, bad) if not b]
        out.append((i, "\n".join(kept), sum(trim(x) != "" for x in lines), sum(bad)))
    return out


def greedy_tiles(document, item, least):
    """Tiles found by comparing all pairs of positions, the longest match first."""
    free_a, free_b, out = [True] * len(document), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(document)):
            for j in range(len(item)):
                n = 0
                while (
                    i + n < len(document) and j + n < len(item)
                    and free_a[i + n] and free_b[j + n] and document[i + n] == item[j + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return sorted(out)
        free_a[i : i + n] = [False] * n
        free_b[j : j + n] = [False] * n
        out.append((i, j, n))


def tiktoken_encoding(path, pattern):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def sha(data):
    return hashlib.sha256(data).hexdigest()


def network_score(net, text):
    """The network's probability for one text, position by position."""
    from tiffinlens.llm import convnet as c

    blocks = max(1, -(-len(text) // c.BLOCK))

    def block(number):
        sums, strings, used = np.zeros(net.bias.size), set(), 0
        for i in range(number * c.BLOCK, min((number + 1) * c.BLOCK, len(text))):
            window = [text[i + k] if i + k < len(text) else c.PAD for k in range(c.WIDTH)]
            sums += np.maximum(sum(net.taps[k][b] for k, b in enumerate(window)) + net.bias, 0)
            strings |= {text[i : i + 4]} if i + 4 <= len(text) else set()
            used += 1
        return sums, len(strings), used

    found = [block(n) for n in range(blocks)]
    best = None
    for n in range(blocks):
        pair = found[n : n + 2]
        size = max(1, sum(p[2] for p in pair))
        features = np.append(sum(p[0] for p in pair) / size, c.SHARE_SCALE * (sum(p[1] for p in pair) / size - 0.5))
        units = np.maximum(features @ net.mix + net.mix_bias, 0)
        best = units if best is None else np.maximum(best, units)
    return float(1 / (1 + np.exp(-(best @ net.out + net.out_bias[0]))))
