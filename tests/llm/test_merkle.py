"""Merkle manifests against trees built whole in plain Python."""

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tiffinlens.llm import merkle, queries

FIELDS = queries.LEAF_FIELDS


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return sha("".join(map(field, row)))


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def brute(rows):
    """[(doc_id, source, lang, n_chars, text)] to the rows of the query."""
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append(row)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for group in by.values():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: levels([leaf(r) for r in by[s]]) for s in sources}
    upper = levels([trees[s][-1][0] for s in sources])
    out = []
    for seat, s in enumerate(sources):
        for place, row in enumerate(by[s]):
            digest, proof = leaf(row), ""
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                digest = leaf((*row[:4], re.sub("[A-Z]", lambda m: m[0].lower(), row[4])))
            for tree, at in ((trees[s], place), (upper, seat)):
                for level in tree[:-1]:
                    left, right = level[at // 16 * 16 : at], level[at + 1 : at // 16 * 16 + 16]
                    proof += "".join(left + right)
                    digest, at = sha("".join(left) + digest + "".join(right)), at // 16
            root = upper[-1][0]
            out.append((row[0], leaf(row), trees[s][-1][0], root, sha(proof), digest, digest == root))
    return out


def rows_of(frame):
    return sorted(
        (tuple(r) for r in frame.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()),
        key=str,
    )


def run(spark, tmp_path, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    frame = spark.createDataFrame(rows, schema)
    for name in ("key", "place", "digest", "part", "owner", "path"):  # names used inside
        frame = frame.withColumn(name, F.lit("mine"))
    frame.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    return rows_of(queries.op12_merkle_manifest(spark, str(tmp_path)))


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_versions_copy_only_ancestors(n):
    leaves = [sha(str(i)) for i in range(n)]
    high = merkle.height(n)
    root = merkle.grow(leaves, high)
    assert [root.digest] == levels(leaves)[-1]
    for place in {0, n // 2, n - 1}:
        other = [*leaves[:place], sha("x"), *leaves[place + 1 :]]
        version = merkle.changed(root, place, high, sha("x"))
        assert version.digest == merkle.grow(other, high).digest == merkle.fold(sha("x"), merkle.siblings(root, place, high))
        assert root.digest == levels(leaves)[-1][0]

        def nodes(node):
            yield id(node)
            for child in node.below:
                yield from nodes(child)

        assert len(set(nodes(version)) - set(nodes(root))) == high + 1


def test_heights():
    assert [merkle.height(n) for n in (0, 1, 2, 16, 17, 256, 257, 4096, 4097)] == [0, 0, 1, 1, 2, 2, 3, 3, 4]


def test_hot_small_and_nameless_sources(spark, tmp_path):
    rows = [(i * 3 - 50, "hot", "en", i, f"Text {i}") for i in range(4200)]
    rows += [(i, f"host{i % 37}", None, None, "Same É text") for i in range(100)]
    rows += [(None, None, None, None, None), (7, None, "x", 1, ""), (None, "", "x", 1, "A"), (5, "", "x", 1, None)]
    rows += [(5, "twice", "x", 1, "A"), (5, "twice", "x", 1, "A"), (5, "twice", "x", 1, "B"), (None, "twice", "x", 1, "B")]
    assert run(spark, tmp_path, rows) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("n", [1, 16, 17])
def test_one_source(spark, tmp_path, n):
    rows = [(i, "only", "en", i, "ABC") for i in range(n)]
    assert run(spark, tmp_path, rows) == sorted(brute(rows), key=str)


def test_no_rows(spark, tmp_path):
    assert run(spark, tmp_path, []) == []
