"""Merkle trees over all rows of a dataset, and what a changed row does to them.

A key's leaves lie side by side, 16 to a node, up to one root. Trees are cut into
aligned blocks of BLOCK leaves, whose levels a task builds at once; the blocks'
roots are the leaves of the next, far smaller round. A changed leaf makes a new
version of its block's tree that shares all untouched nodes: only the changed
leaf's ancestors are copied. A version goes on upwards along the path of its
block, which each block brings down once for all its versions; no group of all
versions of a key is ever gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffinlens.plans.scan import running_sum_before

from .staging import staged

FAN = 16
# Levels of a block, and its leaves: FAN ** LEVELS.
LEVELS = 3
BLOCK_BITS = 4 * LEVELS


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above ``leaves`` of them until one node remains."""
    levels, n = 0, leaves
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


@dataclass(frozen=True)
class Node:
    """A digest and the nodes it was made of; never changed, so versions share it."""

    digest: str
    below: tuple[Node, ...] = ()


def grow(leaves: Sequence[str], levels: int) -> Node:
    """The tree over at most FAN ** ``levels`` leaves."""
    nodes = [Node(d) for d in leaves]
    for _ in range(levels):
        runs = [tuple(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
        nodes = [Node(_hash("".join([n.digest for n in run])), run) for run in runs]
    (root,) = nodes
    return root


def _way(place: int, levels: int) -> list[int]:
    """Which child to take on every level from the root down to the leaf at ``place``."""
    return [place >> 4 * level & FAN - 1 for level in reversed(range(levels))]


def changed(root: Node, place: int, levels: int, leaf: str) -> Node:
    """A new version with another leaf: its ancestors are copied, everything else is shared."""
    way, passed = _way(place, levels), [root]
    for turn in way:
        passed.append(passed[-1].below[turn])
    node = Node(leaf)
    for old, turn in zip(reversed(passed[:-1]), reversed(way)):
        below = (*old.below[:turn], node, *old.below[turn + 1 :])
        node = Node(_hash("".join([n.digest for n in below])), below)
    return node


def siblings(root: Node, place: int, levels: int) -> list[tuple[str, str]]:
    """Digests left and right of the way to a leaf, joined, from the lowest level up."""
    node, out = root, []
    for turn in _way(place, levels):
        digests = [n.digest for n in node.below]
        out.append(("".join(digests[:turn]), "".join(digests[turn + 1 :])))
        node = node.below[turn]
    return out[::-1]


def fold(digest: str, path: Sequence[tuple[str, str]]) -> str:
    """The root that follows from a node and its siblings: the copies of its ancestors, one above the other."""
    for left, right in path:
        digest = _hash(left + digest + right)
    return digest


PATH = "array<struct<left:string,right:string>>"
_SIDES = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _sides(path: Sequence[tuple[str, str]]) -> list[dict]:
    return [{"left": a, "right": b} for a, b in path]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each (key, block), which lie side by side; a block has a bounded number of rows."""
    at, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["key"], row["block"]) != at:
                if rows:
                    yield rows
                at, rows = (row["key"], row["block"]), []
            rows.append(row)
    if rows:
        yield rows


def _levels(row: dict) -> int:
    """Levels of a row's block: all of them, unless its key's tree ends lower."""
    return min(LEVELS, height(row["n"]))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


ROWS = 4096


def _many(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= ROWS:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


_ROOTS = pa.schema([("key", pa.int64()), ("place", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])


def _block_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def one(rows: list[dict]) -> tuple:
        first, levels = rows[0], _levels(rows[0])
        root = grow([r["digest"] for r in rows], levels)
        return first["key"], first["block"], -(-first["n"] // FAN**levels), root.digest

    yield from _many(map(one, _blocks(batches)), _ROOTS)


_PATHS = pa.schema([("key", pa.int64()), ("place", pa.int64()), ("path", _SIDES)])


def _node_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def all_of(rows: list[dict]) -> Iterator[tuple]:
        above = [(p["left"], p["right"]) for p in rows[0]["path"]]
        nodes, levels = rows[1:], _levels(rows[1])
        root = grow([r["digest"] for r in nodes], levels)
        for place, row in enumerate(nodes):
            yield row["key"], row["place"], _sides(siblings(root, place, levels) + above)

    yield from _many((row for rows in _blocks(batches) for row in all_of(rows)), _PATHS)


def _in_blocks(nodes: DataFrame) -> DataFrame:
    """Rows of a block together and in order, in as many tasks as there are blocks, however long a key is."""
    return nodes.repartition("key", "block").sortWithinPartitions("key", "block", "place")


def _with_block(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("place", BLOCK_BITS))


def _below(nodes: DataFrame, heads: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """The rows of each block behind a row of its own: ``heads`` has key, place (the block's), path, digest."""
    kinds = dict(nodes.dtypes)
    nothing = [F.lit(None).cast(kinds[c]).alias(c) for c in ("n", *more)]
    first = heads.select("key", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), "path", "digest", *nothing)
    rows = _with_block(nodes).select("key", "block", "place", F.lit(None).cast(PATH).alias("path"), "digest", "n", *more)
    return _in_blocks(rows.unionByName(first))


def block_roots(nodes: DataFrame) -> DataFrame:
    """key, place, n, digest of the blocks of ``nodes``, which has the same columns; written down."""
    schema = "key long, place long, n long, digest string"
    return staged(_in_blocks(_with_block(nodes).select("key", "block", "place", "n", "digest")).mapInArrow(_block_roots, schema), "merkle")


def paths_to_roots(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, digest of each key's root; key, place, path of each node) for nodes (key, place, n, digest).

    Rounds go up block by block until every key has one node, and back down.
    """
    if nodes.agg(F.max("n")).first()[0] in (None, 1):
        return nodes.select("key", "digest"), nodes.select("key", "place", F.array().cast(PATH).alias("path"))
    roots, above = paths_to_roots(block_roots(nodes))
    heads = above.withColumn("digest", F.lit(None).cast("string"))
    down = _below(nodes, heads).mapInArrow(_node_paths, f"key long, place long, path {PATH}")
    return roots, staged(down, "merkle")


_FINAL = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"
_PROVED = pa.schema(
    [("doc_id", pa.int64())] + [(n, pa.string()) for n in ("leaf", "subroot", "proof_sha256", "folded_root")]
)


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def all_of(rows: list[dict]) -> Iterator[tuple]:
        above = [(p["left"], p["right"]) for p in rows[0]["path"]]
        nodes, levels = rows[1:], _levels(rows[1])
        root = grow([r["digest"] for r in nodes], levels)
        upper, untouched = "".join([a + b for a, b in above]), fold(root.digest, above)
        for place, row in enumerate(nodes):
            lower = "".join([a + b for a, b in siblings(root, place, levels)])
            end = untouched
            if row["changed"] is not None:
                version = changed(root, place, levels, row["changed"])
                end = fold(version.digest, above)
            yield row["doc_id"], row["digest"], rows[0]["digest"], _hash(lower + upper), end

    yield from _many((row for rows in _blocks(batches) for row in all_of(rows)), _PROVED)


def field(value: Column) -> Column:
    """A value as the leaf has it: byte count, colon, value; ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


_MARKED = "doc_id long, source string, digest string, changed string, part long, spot long"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, spot = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        marks = [pa.array([part] * n, pa.int64()), pa.array(range(spot, spot + n), pa.int64())]
        spot += n
        yield pa.RecordBatch.from_arrays([*batch.columns, *marks], names=[*batch.schema.names, "part", "spot"])


def numbered(rows: DataFrame) -> DataFrame:
    """The rows with key, place, n: sources counted in order from 0, their rows by doc_id from 0, and how many these are.

    ``rows`` has doc_id, source, digest, changed. They are dealt by ranges of
    source and doc_id, so a source of a third of all rows is many tasks' work;
    each row gets its spot in its range, and ranges are made up to whole sources
    from their few counts. NULL comes first, as source and as doc_id; equal ids
    stand by digest.
    """
    order = ["source", "doc_id", "digest", "changed"]
    dealt = rows.select("doc_id", "source", "digest", "changed").repartitionByRange(*order).sortWithinPartitions(*order)
    marked = staged(dealt.mapInArrow(_numbered, _MARKED), "merkle")
    # NULL sources are told from empty ones throughout.
    source = F.struct(F.col("source").isNotNull().alias("given"), F.coalesce("source", F.lit("")).alias("name"))
    spans = marked.groupBy("part", source.alias("owner")).agg(F.count("*").alias("rows"), F.min("spot").alias("low"))
    # A source has at most one row here for each range.
    whole = Window.partitionBy("owner")
    spans = spans.select(
        "*",
        F.sum("rows").over(whole).alias("n"),
        (F.sum("rows").over(whole.orderBy("part")) - F.col("rows")).alias("before"),
        F.min("part").over(whole).alias("home"),
    )
    # Sources that begin in a range, of which a task holds all rows, and the number of those of earlier ranges.
    begun = spans.where("part = home").withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy("owner")))
    counted = begun.groupBy("part").agg(F.count("*").alias("begun"))
    earlier = running_sum_before(counted, "part", F.col("begun"), "earlier").select("part", "earlier")
    keys = begun.join(earlier, "part").select("owner", (F.col("earlier") + F.col("nth") - 1).alias("key"))
    spans = staged(spans.join(keys, "owner").select("part", "owner", "key", "n", "before", "low"), "merkle")
    rows = (
        marked.withColumn("owner", source)
        .join(spans, ["part", "owner"])
        .select("key", (F.col("spot") - F.col("low") + F.col("before")).alias("place"), "n", "doc_id", "digest", "changed")
    )
    return staged(rows, "merkle")


def manifest(documents: DataFrame, fields: Sequence[str], tampered: Column, changes: dict[str, Column]) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of ``documents`` (doc_id, source, ...).

    Leaves hash ``fields``; where ``tampered`` holds, ``changes`` replaces some of
    them in the version that is folded. NULL fields have a leaf of their own;
    equal rows are leaves side by side. ``root`` is that of all sources' roots.
    A table without rows has no tree, and gives no rows.
    """
    plain = leaf([documents[c] for c in fields])
    other = leaf([changes.get(c, documents[c]) for c in fields])
    found = documents.select(
        documents["doc_id"].cast("long").alias("doc_id"),
        documents["source"].alias("source"),
        plain.alias("digest"),
        F.when(tampered, other).alias("changed"),
    )
    rows = numbered(found)
    roots, up = paths_to_roots(block_roots(rows))
    # The sources' roots are the leaves of the last tree.
    one = F.lit(0).cast("long").alias("key")
    tops = staged(roots.select(one, F.col("key").alias("place"), F.lit(roots.count()).cast("long").alias("n"), "digest"), "merkle")
    top, across = paths_to_roots(tops)
    root = top.first()
    onward = across.join(tops, ["key", "place"]).select(F.col("place").alias("key"), F.col("path").alias("onward"), "digest")
    heads = up.join(onward, "key").select("key", "place", F.concat("path", "onward").alias("path"), "digest")
    proved = _below(rows, heads, ("doc_id", "changed")).mapInArrow(_proofs, _FINAL)
    return proved.select(
        "doc_id",
        "leaf",
        "subroot",
        F.lit(root["digest"] if root else None).cast("string").alias("root"),
        "proof_sha256",
        "folded_root",
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
