"""Benchmark decontamination by greedy string tiling.

Shared-token seeds find the candidate pairs: runs of SEED tokens of the
benchmark items are joined with those of the documents. Each pair is then tiled:
longest matches first, every token of either side in one tile at most, found by
running Karp-Rabin hashes. What share of an item its tiles cover says whether
the document holds it, in whatever order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged

# Tokens of a seed, and so of the shortest tile.
SEED = 5
# Tokens of the shortest item that is looked for.
SHORTEST = 3
# Share of an item's tokens that tiles must cover.
COVERAGE = 0.5
# First length searched; matches are found whole however long they are.
FIRST_LENGTH = 20
TOKEN_BREAK = r"[^\p{L}\p{N}]+"
BASE, MODULUS = 1_000_003, (1 << 61) - 1


def tokens_of(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), TOKEN_BREAK), "")


def _runs(hashes: str, length: int) -> Column:
    """Hashes of all runs of ``length`` tokens."""
    runs = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - length),
        lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(length)]),
    )
    return F.when(F.size(hashes) >= length, runs).otherwise(F.array().cast("array<bigint>"))


def seeds_of(
    texts: DataFrame, ids: list[str], text: str = "text", length: int = SEED, shorter: Sequence[int] = (), whole: bool = False
) -> DataFrame:
    """ids, seed: one row per different run of ``length`` or of ``shorter`` tokens of a text.

    If ``whole``, shorter runs count only where they are all there is of the text.
    """
    runs = [_runs("__hashes", length)]
    for n in shorter:
        some = _runs("__hashes", n)
        runs.append(F.when(F.size("__hashes") == n, some).otherwise(F.array().cast("array<bigint>")) if whole else some)
    return (
        texts.select(*ids, tokens_of(F.col(text)).alias("__tokens"))
        .select(*ids, F.transform("__tokens", lambda t: F.xxhash64(t)).alias("__hashes"))
        .select(*ids, F.explode(F.array_distinct(F.concat(*runs))).alias("seed"))
    )


def _hashes(tokens: list[int], free: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """(start, rolling hash) of each run of ``length`` free tokens."""
    top = pow(BASE, length - 1, MODULUS)
    value = run = 0
    for i, token in enumerate(tokens):
        if not free[i]:
            value = run = 0
            continue
        if run == length:
            value = (value - tokens[i - length] * top) % MODULUS
        else:
            run += 1
        value = (value * BASE + token) % MODULUS
        if run == length:
            yield i - length + 1, value


def tiles(document: list[str], item: list[str], least: int = SEED) -> list[tuple[int, int, int]]:
    """(start in document, start in item, length) of greedy tiles of ``least`` tokens or more.

    The longest match is marked first; of equal ones that which starts first in
    the document, then in the item.
    """
    numbers: dict[str, int] = {}
    a = [numbers.setdefault(t, len(numbers) + 1) for t in document]
    b = [numbers.setdefault(t, len(numbers) + 1) for t in item]
    free_a, free_b = [True] * len(a), [True] * len(b)
    out: list[tuple[int, int, int]] = []
    length = max(least, min(FIRST_LENGTH, len(b)))
    while True:
        places: dict[int, list[int]] = {}
        for start, value in _hashes(b, free_b, length):
            places.setdefault(value, []).append(start)
        matches: list[tuple[int, int, int]] = []
        if places:
            for start, value in _hashes(a, free_a, length):
                for other in places.get(value, ()):
                    if start and other and free_a[start - 1] and free_b[other - 1] and a[start - 1] == b[other - 1]:
                        continue  # part of the match that starts earlier
                    n = 0
                    while (
                        start + n < len(a)
                        and other + n < len(b)
                        and free_a[start + n]
                        and free_b[other + n]
                        and a[start + n] == b[other + n]
                    ):
                        n += 1
                    if n >= length:
                        matches.append((n, start, other))
        longest = max((m[0] for m in matches), default=0)
        if longest > 2 * length:
            length = longest
            continue
        again = False
        for n, start, other in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if all(free_a[start : start + n]) and all(free_b[other : other + n]):
                free_a[start : start + n] = [False] * n
                free_b[other : other + n] = [False] * n
                out.append((start, other, n))
            else:
                again = True  # what an earlier tile left of it may still be long
        if again:
            continue
        if length == least:
            return sorted(out)
        length = max(least, length // 2)


def coverage_of(document: list[str], item: list[str], least: int = SEED) -> tuple[int, int]:
    """(tokens of the item in tiles, tiles); an item of fewer than ``least`` tokens is one tile or none."""
    found = tiles(document, item, max(1, min(least, len(item))))
    return sum(n for _, _, n in found), len(found)


def _tile(least: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [coverage_of(list(d), list(i), least) for d, i in zip(frame["document"], frame["item"])]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "item_id": frame["item_id"],
                    "n_tokens": [len(i) for i in frame["item"]],
                    "n_covered": [c for c, _ in found],
                    "n_tiles": [n for _, n in found],
                }
            )

    return run


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    least: int = SEED,
    coverage: float = COVERAGE,
) -> DataFrame:
    """doc_id, item_id, n_tokens, n_covered, n_tiles, coverage of pairs with enough of the item covered.

    An item of fewer than ``least`` tokens is found where it stands whole; one of
    fewer than SHORTEST is a word or two that any text may have, and matches
    nothing, as do NULL and empty texts. NULL ids are left out. Of rows that share an id and a text one counts; rows
    that share a doc_id with different texts are tiled each, and the pair has
    the highest coverage.
    """
    items = benchmark.where("item_id IS NOT NULL").select("item_id", "text").distinct()
    docs = documents.where("doc_id IS NOT NULL").select("doc_id", "text")
    # The join broadcasts the items' seeds only if they are below the session's threshold.
    size = F.size(tokens_of(F.col("text")))
    few = items.select(size.alias("n")).where(F.col("n").between(SHORTEST, least - 1)).distinct()
    shorter = sorted(row.n for row in few.collect())  # lengths below ``least``
    seeds = staged(seeds_of(items, ["item_id"], length=least, shorter=shorter, whole=True), "seeds")
    found = seeds_of(docs, ["doc_id"], length=least, shorter=shorter)
    pairs = staged(found.join(seeds, "seed").select("doc_id", "item_id").distinct(), "pairs")
    tokens = items.select("item_id", tokens_of(F.col("text")).alias("item"))
    tiled = (
        # Documents first, while the pairs' size is known: few pairs are broadcast and no text is shuffled.
        docs.join(pairs, "doc_id")
        .join(tokens, "item_id")
        .select("doc_id", "item_id", tokens_of(F.col("text")).alias("document"), "item")
        .mapInPandas(_tile(least), "doc_id long, item_id long, n_tokens long, n_covered long, n_tiles long")
    )
    return (
        tiled.where(F.col("n_covered") >= coverage * F.col("n_tokens"))
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("n_covered", "n_tiles", "n_tokens")).alias("best"))
        .select("doc_id", "item_id", "best.n_tokens", "best.n_covered", "best.n_tiles")
        .withColumn("coverage", F.col("n_covered") / F.col("n_tokens"))
    )


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, least: int = SEED, coverage: float = COVERAGE
) -> DataFrame:
    """Rows of ``documents`` that hold no item of the benchmark; rows without a doc_id stay."""
    found = staged(contaminated(documents, benchmark, least, coverage).select("doc_id").distinct(), "leaks")
    return documents.join(found, "doc_id", "left_anti").select(*documents.columns)
