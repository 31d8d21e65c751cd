"""Language identification: the sizes against one encoding by hand, held-out accuracy, and odd rows."""

import pytest
from pyspark.sql import functions as F

from fieldpulse.llm import language_id, queries

SF = "/root/testdata/sf0.01"
PARTS = {"xx": "ba be bi bo bu ban ben bin", "yy": "ka ke ki ko ku kat ket kit"}


def text(lang, size, salt):
    parts = PARTS[lang].split()
    return " ".join(parts[(i * 7 + salt * i * i) % len(parts)] + parts[(i * salt + 3) % len(parts)] for i in range(size))


@pytest.fixture
def learned(spark):
    rows = [(text(lang, 60, salt), lang) for lang in PARTS for salt in range(1, 20)]
    rows += [(None, "xx"), ("", "yy"), ("12 34", "zz"), ("lost words", None)] + [(text("xx", 60, 1), "xx")] * 5
    return language_id.learn(spark.createDataFrame(rows, "text string, lang string"), F.lit(True))


def test_languages_by_documents(learned):
    assert learned.names == ["xx", "yy"]
    assert all(len(held) <= language_id.Encoder().dictionary_bytes for held in learned.dictionaries)


def test_choice_is_the_smallest_encoding(spark, learned):
    rows = [(1, text("xx", 40, 31)), (2, text("yy", 40, 31)), (3, text("yy", 20_000, 31).upper()), (4, "!" * 50_000 + text("yy", 30, 5) + "7" * 1000), (5, None), (6, ""),
            (7, "123 ... \n"), (8, "q"), (9, "É"), (9, "É"), (None, text("xx", 30, 2))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({name: F.lit("clash") for name in ("letters", "_row", "score", "margin", "lang_pred", "lang")})
    got = language_id.identify(frame, learned).collect()
    encoder = language_id.Encoder()
    compressors = [encoder.compressor(held) for held in learned.dictionaries]
    assert len(got) == len(rows)
    for row in got:
        assert 0 <= row.score <= 1 and row.lang_pred in ("xx", "yy", "und")
    by_id = {row.doc_id: row for row in got}
    assert [by_id[i].lang_pred for i in (1, 2, 3, 4, None)] == ["xx", "yy", "yy", "yy", "xx"]
    assert [by_id[i].lang_pred for i in (5, 6, 7)] == ["und"] * 3 and by_id[5].rejected and by_id[5].score == 0
    assert by_id[8].lang_pred == "xx" and by_id[8].rejected and by_id[8].score == 0.5
    plain = text("yy", 20_000, 31).encode()
    sizes = [sum(len(one.compress(plain[i:i + encoder.piece_bytes])) for i in range(0, len(plain), encoder.piece_bytes)) for one in compressors]
    assert by_id[3].margin == pytest.approx((sizes[0] - sizes[1]) / sizes[0])
    kept = language_id.identify(frame, learned, keep=("doc_id", "score")).columns
    assert kept[:2] == ["doc_id", "score"]


def test_nothing_learned(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    known = language_id.learn(empty, F.lit(True))
    row = language_id.identify(spark.createDataFrame([(1, "words")], "doc_id long, text string"), known).first()
    assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
    assert language_id.identify(empty.withColumn("doc_id", F.lit(1)), known).count() == 0


def test_held_out_documents(spark):
    found = queries.op11_language_id(spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out and lang_pred != 'und'").collect()
    assert len(rows) > 200
    assert sum(row.lang == row.lang_pred for row in rows) >= 0.97 * len(rows)
    firm = [row for row in rows if not row.rejected]
    assert sum(row.lang == row.lang_pred for row in firm) >= 0.98 * len(firm) and len(firm) >= 0.95 * len(rows)
