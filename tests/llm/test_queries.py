"""The registered training-data queries on whole small tables, against SQL or brute force."""

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from tests.llm import brute
from tiffinlens.llm import oracles, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    found = duckdb.connect()
    for name in ("documents", "pages", "conversations"):
        found.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return found


def listed(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(str, frame.where(frame.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_query_equals_sql(spark, connection, name):
    want = connection.execute(oracles.ORACLES[name]).df()
    assert listed(queries.QUERIES[name](spark, SF).toPandas()) == listed(want)


def test_chained_calls_equal_sql(spark, connection):
    found = queries.MORE_QUERIES["op10_chat_format_chained"](spark, SF).toPandas()
    assert listed(found) == listed(connection.execute(oracles.MORE_ORACLES["op10_chat_format_chained"]).df())
    assert found[found.role == "tool_call"].step.max() > 1 and set(oracles.MORE_ORACLES) == set(queries.MORE_QUERIES)


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 1 + len(queries.QUERIES)))


def test_simhash_equals_brute_force(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    want = [(i, f"{p:016x}", c) for i, p, c in brute.simhash_components(list(zip(docs.doc_id, docs.text)))]
    assert sorted(map(tuple, queries.QUERIES["op5_simhash"](spark, SF).collect())) == sorted(want)


def test_pipeline_stages(spark):
    """Each stage keeps the columns of documents; the last has the tokens of what is left."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), "test")
        assert docs.columns == columns and docs.count() <= before
        before = docs.count()
    rows = docs.toPandas()
    prints = [p for _, p, _ in brute.simhash_components(list(zip(rows.doc_id, rows.text)))]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas().set_index("doc_id")
    assert all(last.loc[i].decoded_sha256 == brute.sha(t.encode()) for i, t in zip(rows.doc_id, rows.text))


def small_tables(spark, folder, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    # Names that operators use inside.
    for name in ("value", "host", "blob", "score", "position", "component_id", "seed"):
        docs = docs.selectExpr("*", f"'mine' as {name}")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], int(r[0]) % 2) for r in rows if r[0] is not None]
    spark.createDataFrame(labels + [(None, 1), (3, None)] * bool(rows), "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, "seven words that no text here holds"), (2, None), (None, "x")] * bool(rows)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    pages = [(r[0], r[3], r[1]) for r in rows]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    turns = [(r[0], i, "user" if i % 2 else None, r[1]) for i, r in enumerate(rows)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


ODD = [
    (None, None, None, None, None),
    (1, "", "", "", 0),
    (2, None, "en", "a", None),
    (3, "word " * 30, "en", "a", 1),
    (3, "word " * 30, "en", "a", 1),
    (4, "another text " * 5000 + "\n" * 50, "en", None, 1),
    (None, "text without an id", "xx", "a", 9),
]


@pytest.mark.parametrize("rows", [[], ODD], ids=["empty", "odd"])
def test_every_query_takes_empty_and_odd_tables(spark, tmp_path, rows):
    folder = small_tables(spark, tmp_path, rows)
    for name, query in queries.QUERIES.items():
        found = query(spark, folder).count()
        if name not in ("op8_decontamination", "op10_chat_format"):
            assert found == len(rows), name
    last = corpus_pipeline.run(spark, folder)
    assert "doc_id" in last.columns and last.count() <= len(rows)
