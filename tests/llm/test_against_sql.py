"""Queries next to their SQL counterparts: on a given table, on awkward rows and on empty tables."""

import math

import pytest
from compare import difference, duck
from helpers import DOCUMENTS, against_sql, awkward_documents, documents, prose, written

import __spark_entry__ as E
from mirrorflow.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ON_DOCUMENTS = [n for n in ORACLES if n.split("_")[0] in ("op4", "op8", "op9", "op10")]


@pytest.mark.parametrize("name", list(ORACLES))
def test_given_table(spark, name):
    assert difference(E.queries()[name](spark, SF), duck(SF), E.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ON_DOCUMENTS)
def test_awkward_documents(spark, tmp_path, name):
    rows = awkward_documents() + [(300 + i, t, "en", "s9", 0) for i, t in enumerate(PERSONAL)]
    sf_dir = written(tmp_path, documents=documents(spark, rows))
    assert against_sql(spark, name, sf_dir, ["documents"]) is None


@pytest.mark.parametrize("name", ON_DOCUMENTS)
def test_empty_documents(spark, tmp_path, name):
    sf_dir = written(tmp_path, documents=spark.createDataFrame([], DOCUMENTS))
    assert against_sql(spark, name, sf_dir, ["documents"]) is None


IBAN = "GB82 WEST 1234 5698 7654 32"
PERSONAL = [
    "mail a.b+c@mail.example.com, b@c, d@e.f@g.h x@y.z_w@q.r. @a.b a@b. c@d.e.",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255 1.2.3 9.9.9.9999 1.2..3.4",
    "4111 1111 1111 1111, 4111-1111-1111-1112, 4111111111111111 1, 41111111111111110000, 5500 0000 0000 0004",
    "+1 (319) 555-5132 +12 +1234567890 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 + 1234567890 +1()()()()1",
    f"IBAN {IBAN}. {IBAN}X GB82WEST12345698765432 GB83WEST12345698765432 DE89370400440532013000 XX89370400440532013000",
    "ssn 123-45-6789 and 123-45-6789 with social security 123-45-67890 tax id:987-65-4321",
    "é" * 50 + " ü@x.yz 1.2.3.4 \U0001f600 +1 (319) 555-5132\n4111111111111111",
    "a@b." + "c." * 6000 + "d " + "a" * 20000 + "@" + "x.y",
    " ".join(f"u{i}@h{i % 7}.example.org 10.0.0.{i % 300}" for i in range(700)),
    "+" + "1 " * 9000 + "2",
    f"{IBAN} BIC COBADEFFXXX DE89370400440532013000 Please DE89 3704 0044 0532 0130 00 2024 AB12 {IBAN}, é{IBAN} -{IBAN}",
    " ".join(["GB82WEST12345698765432", "DE89370400440532013000", "NO9386011117947"] * 40),
]


def test_temperature_mix_of_uneven_sources(spark, tmp_path):
    """One source holds most tokens: the exponent lies between 0 and 1 and others are repeated."""
    rows = [(i, prose(i, 20 + i % 50), "en", "big", 0) for i in range(300)]
    rows += [(1000 + i, prose(i, 30), "en", f"small{i % 3}", 0) for i in range(60)]
    rows += [(2000, "", "en", "nothing", 0), (2001, None, "en", "nothing", 0)]
    sf_dir = written(tmp_path, documents=spark.createDataFrame(rows, DOCUMENTS))
    assert against_sql(spark, "op10_temperature_mix", sf_dir, ["documents"]) is None
    copies = QUERIES["op10_temperature_mix"](spark, sf_dir).groupBy("source").agg({"copy": "max"})
    most = {r[0]: r[1] for r in copies.collect()}
    assert most["big"] == 0 and most["nothing"] == 0 and max(most.values()) == 1


def test_mix_spreads_rows_without_tokens(spark, tmp_path):
    rows = [(i, prose(i, 300), "en", "s1", 0) for i in range(1000)] + [(5000 + i, None, "en", "s2", 0) for i in range(600)]
    sf_dir = written(tmp_path, documents=spark.createDataFrame(rows, DOCUMENTS))
    assert against_sql(spark, "op10_temperature_mix", sf_dir, ["documents"]) is None
    blocks = QUERIES["op10_temperature_mix"](spark, sf_dir).filter("n_tokens = 0").groupBy("block").count().collect()
    assert len(blocks) == 2 and all(240 <= r[1] <= 360 for r in blocks)


def test_awkward_conversations(spark, tmp_path):
    hard = [
        "", None, "### user:\nhi</turn>\n", "\\", "\\\\###", "####", "#####</turn></turn>", "<", "</turn", "a\\</turn>\\",
        "### Assistant: ", "\n", "x" * 9000, "é\U0001f600" * 40,
    ]
    rows = [(1, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(hard)]
    rows += [(2, i, ["system", "user", "assistant"][min(i, 1 + i % 2)], prose(i, 5 + 37 * (i % 9))) for i in range(60)]
    rows += [(3, 0, "system", "only"), (4, 0, None, None), (4, None, "role: </turn>\n### x", "t"), (4, 0, None, None)]
    rows += [(5, i, "assistant", "") for i in range(300)] + [(None, 0, "user", "q"), (None, 1, "assistant", "a")]
    rows += [(6, i, "system", "s " * 3000) for i in range(3)] + [(6, 3, "assistant", "x")]
    rows += [(7, i, "assistant", "word " * 100) for i in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 as window", "2 as idx", "'x' as piece", "3 as tokens")
    sf_dir = written(tmp_path, conversations=df)
    assert against_sql(spark, "op2_chat_windows", sf_dir, ["conversations"]) is None
    sf_dir = written(tmp_path, conversations=df.limit(0))
    assert against_sql(spark, "op2_chat_windows", sf_dir, ["conversations"]) is None


def test_awkward_pages(spark, tmp_path):
    long, longer = "<p>" + prose(1, 300) + "</p>", "é" * 700
    rows = [(i, f"http://h/{i}", t) for i, t in enumerate([long, longer, "short", "short", None, "", long, longer, long])]
    rows += [(20, None, long), (20, None, long), (21, "http://x\r\ny", "z" * 999), (22, "u", "z" * 999), (23, "u", "z" * 1000)]
    rows += [(24, "u", "z" * 1000), (30 + 2**53, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 40), (40, "u", prose(3, 50_000))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.selectExpr("*", "1 as id", "'x' as payload_digest", "'t' as record_type", "'y' as text", "3 as refers_to")
    sf_dir = written(tmp_path, pages=df)
    assert against_sql(spark, "op6_warc_dictionary", sf_dir, ["pages"]) is None
    nulls = spark.createDataFrame([(None, "u", long), (None, "u", long), (None, None, "s")], "page_id long, url string, html string")
    out = QUERIES["op6_warc_dictionary"](spark, written(tmp_path, pages=nulls)).collect()
    assert [(r.page_id, r.record_type, r.refers_to) for r in out] == [(None, "response", None)] * 3


def test_empty_pages(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert against_sql(spark, "op6_warc_dictionary", written(tmp_path, pages=df), ["pages"]) is None


def test_awkward_vectors(spark, tmp_path):
    v = [0.5, 0.25, -1.0]
    rows = [
        (1, v, 0), (2, v, 0), (3, [1.0, 0.5, -2.0], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [], 0),
        (8, [0.0, 0.0, 0.0], 0), (9, [0.5, None, 1.0], 0), (10, [math.nan, 1.0, 1.0], 0), (11, [math.inf, 1.0, 1.0], 0),
        (12, [0.5, 0.25, -1.05], 0), (13, [-0.5, -0.25, 1.0], 0), (14, [0.5, 0.25], 0), (15, [0.5, 0.25], 0),
        (16, [1e-30, 0.0, 0.0], 2), (17, [1e30, 0.0, 0.0], 2),
    ]
    # a chain whose ends are no link of each other
    rows += [(30 + i, [math.cos(0.15 * i), math.sin(0.15 * i), 0.0], 3) for i in range(9, -1, -1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.selectExpr("*", "1 as n", "2 as grp", "3 as cell", "4 as id", "5 as component")
    sf_dir = written(tmp_path, embeddings=df)
    assert against_sql(spark, "op1_cover_tree_dedup", sf_dir, ["embeddings"]) is None
    sf_dir = written(tmp_path, embeddings=df.limit(0))
    assert against_sql(spark, "op1_cover_tree_dedup", sf_dir, ["embeddings"]) is None
