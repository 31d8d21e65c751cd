"""Chat formatting, neighbours, the pipeline, and the queries next to their SQL."""

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
SF = "/root/testdata/sf0.001"

import corpus_pipeline
from check_queries import TABLES, comparable
from fieldpulse.llm import chat, decontaminate, neighbours, queries


def test_chat_round_trip(spark):
    rows = [(1, 0, "system", "<|end|>[INST]\\s\\l"), (1, 1, "user", None), (1, 2, "assistant", "</s>[/INST]"), (1, 3, "user", "é\n"), (1, 4, "assistant", ""),
            (1, 5, "user", "last"), (2, 0, "user", "only"), (2, 0, "user", "only"), (None, 1, None, "x")]
    made = chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    held = made.select("*", chat.read_back(made.text).alias("turns")).orderBy("conv_id", "n_turns").collect()
    longest = {row.conv_id: [(t.role, t.text) for t in row.turns] for row in held}
    assert longest[1] == [(role, text or "") for conv, _, role, text in rows if conv == 1]
    assert longest[2] == [("user", "only")] * 2 and longest[None] == [("", "x")]
    losses = [row.text[row.loss_start:row.loss_end] for row in held if row.conv_id == 1]
    assert losses == ["\\l/s>\\b/INST]", "", ""]


def test_neighbours_match_brute_force(spark):
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(300, 16)).astype(np.float32)
    vectors[50:110] = vectors[40]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0, None]), (904, [float("inf")] * 16), (None, [1.0] * 16), (905, [])]
    tiles = neighbours.Tiles(queries=7, candidates=40, k=5)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(table, F.col("vec_id") % 20 == 0, tiles).orderBy("query_id", "rank").collect()
    exact = vectors.astype(np.float64)
    expected = []
    for query in range(0, 300, 20):
        scores = sum(exact[query, d] * exact[:, d] for d in range(16))
        best = sorted((i for i in range(300) if i != query), key=lambda i: (-scores[i], i))[:5]
        expected += [(query, rank + 1, i, scores[i]) for rank, i in enumerate(best)]
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [e[:3] for e in expected]
    assert np.allclose([r.score for r in got], [e[3] for e in expected], rtol=1e-15)
    assert neighbours.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("times", [2, 21])
def test_neighbours_of_a_repeated_id(spark, times):
    """The query's own rows take no places from the 25 other ids that hold the same vector."""
    rows = [(20, [1.0, 0.0])] * times + [(21 + i, [1.0, 0.0]) for i in range(25)] + [(900 + i, [0.5, 0.5]) for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(table, F.col("vec_id") == 20).collect()
    assert len(got) == 20
    # Each of the query's rows asks, so an id comes once per row, the smallest ids first.
    assert [row.vec_id for row in sorted(got, key=lambda r: r["rank"])] == [21 + i // times for i in range(20)]


def test_wide_tiles_are_exact():
    """2,000 products of 127 * 127 - 1 and the like do not fit the 24 bits of a float32."""
    values = np.full((1, 2001), 127.0)
    values[0, 0] = 126
    made = neighbours._quantised(values)[0]
    assert int((made @ made.T)[0, 0]) == 2000 * 127 ** 2 + 126 ** 2 and made.dtype == np.float64


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = comparable(queries.queries()[name](spark, SF).toPandas())
    expected = comparable(connection.execute(queries.oracle_sql()[name]).df())
    assert got.equals(expected) and len(got)


@pytest.mark.parametrize("block_words", [1 << 20, 9])
def test_items_without_an_id_agree_with_sql(spark, tmp_path, monkeypatch, block_words):
    words = " ".join(f"b{i}" for i in range(14))
    docs = [(1, f"a {words} b"), (2, "clean text"), (3, "short item"), (4, f"short item {words}"), (5, None)]
    items = [(None, words), (None, "short item"), (7, f"x {words}"), (8, None), (None, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    monkeypatch.setattr(decontaminate.find_contamination, "__defaults__", (decontaminate.Windows(block_words=block_words), ("doc_id",)))
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    got = queries.op8_decontamination(spark, str(tmp_path)).toPandas()
    assert comparable(got).equals(comparable(connection.execute(queries.oracle_sql()["op8_decontamination"]).df()))
    assert got.set_index("doc_id").contaminated.to_dict() == {1: True, 2: False, 3: True, 4: True, 5: False}
    cut = decontaminate.without_passages(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {row.doc_id: row.text for row in cut.collect()} == {1: "a  b", 2: "clean text", 5: None}


def test_pipeline_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.schema.names == docs.schema.names
        docs = spark.createDataFrame(after.collect(), docs.schema)
    assert docs.count() == len({hashlib.sha256((row.text or "").encode()).hexdigest() for row in docs.collect()})
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {"doc_id", "copies", "taken"} <= set(mixed.columns) and mixed.count()


def test_tile_keeps_vectors_too_small_for_a_scale():
    """The scale of a vector of subnormal numbers is not zero, so no candidate is lost to a division by it."""
    vectors = np.array([[5e-324, 0.0], [1.0, 2.0], [0.0, 5e-324]])
    heaps = neighbours._Heaps(np.arange(3), 2)
    neighbours._tile(vectors, np.arange(3), vectors, np.arange(3), heaps)
    assert [{-i for _, i in heap} for heap in heaps.heaps] == [{1, 2}, {0, 2}, {0, 1}]
