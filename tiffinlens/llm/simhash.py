"""SimHash near-dedup: 64-bit fingerprints, linked by BK-trees over shards of the fingerprint space.

Equal fingerprints are one value. The bits are cut into radius + k blocks; two
values within the radius agree on at least k whole blocks, so each choice of k
blocks deals the values into shards that together hold every link. Trees are
built per shard, in tasks; a shard over SHARD values is cut into parts, and
every two parts meet in a task of their own. Nothing of it passes the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .hamming import linked
from .staging import staged

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
BITS = 64
# Values of one tree at most.
SHARD = 4096
# Shards wanted per value at least: more blocks must agree as values grow in number.
VALUES_PER_SHARD = 4
# Shingles hashed before their bits are counted.
BLOCK = 1 << 16


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """A bit is 1 if set in over half the shingles' hashes; 0 for no words."""
    tokens = text.lower().split()  # of bytes: A-Z, and the six ASCII blanks
    if not tokens:
        return 0
    ones = np.zeros(BITS, np.int64)
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(words, len(tokens))
    n = len(tokens) - width + 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        to = min(at + BLOCK, n)
        spans = zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(words: int):
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        values = [fingerprint(t.encode(), words) if t else 0 for t in texts]
        return pd.Series(np.array(values, np.uint64).view(np.int64))

    return of


def blocks_to_agree(values: int, radius: int = RADIUS) -> int:
    """How many blocks must agree for VALUES_PER_SHARD values or fewer per shard if bits were random."""
    for k in range(1, BITS - radius):
        if values / 2.0 ** (k * (BITS // (radius + k))) <= VALUES_PER_SHARD or comb(radius + k, k) > 200:
            return k
    return 1


def shard_masks(radius: int, agree: int) -> list[int]:
    """The bits of each choice of ``agree`` among radius + agree blocks."""
    count = radius + agree
    borders = [BITS * i // count for i in range(count + 1)]
    blocks = [((1 << borders[i + 1]) - 1) ^ ((1 << borders[i]) - 1) for i in range(count)]
    return [sum(chosen) for chosen in combinations(blocks, agree)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def sharded(values: DataFrame, masks: list[int], shard: int = SHARD) -> DataFrame:
    """place, part, other, value: each value in all its shards of two values or more, and their pairs of parts."""
    places = F.array(
        *[
            F.struct(F.lit(i).alias("table"), F.col("value").bitwiseAND(F.lit(_signed(m))).alias("bits"))
            for i, m in enumerate(masks)
        ]
    )
    members = values.select("value", F.explode(places).alias("place")).select("value", "place.*")
    sizes = members.groupBy("table", "bits").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / shard).cast("int")
    mine = F.pmod(F.xxhash64("value"), F.col("parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: F.struct(F.least("mine", j).alias("part"), F.greatest("mine", j).alias("other")),
    )
    return (
        members.join(sizes, ["table", "bits"])
        .withColumn("parts", parts)
        .withColumn("mine", mine)
        .select("table", "bits", "value", F.explode(pairs).alias("pair"))
        .select("table", "bits", "pair.*", "value")
    )


def _search(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches come sorted by shard; the last, perhaps unfinished shard of each waits for the next batch."""
        keys = ["table", "bits", "part", "other"]
        held: list[np.ndarray] = []

        def links(rows: np.ndarray) -> pa.RecordBatch:
            new = np.r_[True, (rows[1:, :-1] != rows[:-1, :-1]).any(axis=1)]
            a, b = linked(np.cumsum(new), np.ascontiguousarray(rows[:, -1]).view(np.uint64), radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack(
                [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in [*keys, "value"]], axis=1
            )
            differs = np.flatnonzero((rows[:, :-1] != rows[-1, :-1]).any(axis=1))
            cut = differs[-1] + 1 if len(differs) else 0
            if cut or (held and (held[-1][-1, :-1] != rows[0, :-1]).any()):
                yield links(np.concatenate([*held, rows[:cut]]))
                held = []
            held.append(rows[cut:])
        if held:
            yield links(np.concatenate(held))

    return run


def links_between(values: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """a, b: links that connect what is connected within ``radius``; ``value`` must be distinct and settled."""
    masks = shard_masks(radius, blocks_to_agree(values.count(), radius))
    keys = ["table", "bits", "part", "other"]
    return (
        sharded(values, masks, shard)
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_search(radius), "a long, b long")
        .distinct()
    )


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _rooted(documents: DataFrame, words: int, radius: int, shard: int) -> DataFrame:
    """doc_id, value, root, component_id: the fingerprint, one fingerprint that stands for its component, the smallest id there."""
    prints = staged(
        documents.select("doc_id", fingerprints(words)("text").alias("value")), "fingerprints"
    )
    values = staged(prints.groupBy("value").agg(F.min("doc_id").alias("least")), "values")
    roots = components(links_between(values.select("value"), radius, shard))
    rooted = values.join(roots, values["value"] == roots["node"], "left").select(
        "value", "least", F.coalesce("root", "value").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(lowest, "root").select("value", "root", "component_id")
    return prints.join(classes, "value").select("doc_id", "value", "root", "component_id")


def with_components(
    documents: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, shard: int = SHARD
) -> DataFrame:
    """doc_id, fingerprint (bigint), component_id for every row of ``documents``.

    Texts without words, NULL or empty, have fingerprint zero and are linked like
    any other. Repeated rows give repeated rows. A component's id is the smallest
    doc_id in it that is not NULL; NULL if there is none.
    """
    return _rooted(documents, words, radius, shard).select("doc_id", F.col("value").alias("fingerprint"), "component_id")


def keep_first(
    documents: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, shard: int = SHARD
) -> DataFrame:
    """The document of each component whose doc_id is the smallest, with all its columns.

    Of rows that share a doc_id and a component one stays, the first by a fixed
    order of their texts; rows that share a doc_id in different components are
    decided each by its own. Rows without a doc_id are not told apart and stay
    as they are.
    """
    classes = staged(_rooted(documents, words, radius, shard), "components")
    repeated = staged(
        classes.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated"
    )
    copies = classes.where("doc_id <> component_id").select("doc_id").join(repeated, "doc_id", "left_anti")
    gone = staged(copies, "copies")
    single = documents.join(gone, "doc_id", "left_anti").join(repeated, "doc_id", "left_anti")
    # Few rows as a rule: only these are fingerprinted again, to find each its own component.
    own = classes.join(repeated, "doc_id", "left_semi").where("doc_id = component_id")
    own = own.select("doc_id", F.col("value").alias("__print"), F.col("root").alias("__root")).distinct()
    several = documents.join(repeated, "doc_id", "left_semi").withColumn("__print", fingerprints(words)("text"))
    first = F.struct(F.sha2("text", 256), F.xxhash64(*documents.columns))
    chosen = (
        several.join(own, ["doc_id", "__print"])
        .groupBy("doc_id", "__root")
        .agg(F.min_by(F.struct(*documents.columns), first).alias("__row"))
        .select("__row.*")
    )
    return single.unionByName(chosen).select(*documents.columns)
