"""Small tables with awkward rows, and queries held against their SQL counterparts on them."""

import random
import uuid

from compare import difference, duck

from mirrorflow.llm.queries import ORACLES, QUERIES

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ", rank int, kept boolean, kind string, _row int, copy int, tokens string, n_words string, id int, rep int"


def prose(seed, words, vocabulary=400):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(words))


def awkward_documents():
    """Nulls in every column, empty and blank texts, repeated rows, ties and a very long text."""
    texts = [
        None, "", " \t\n\x0b\x0c\r ", "one", "one two three four", "a b c d e", "a b c d e", "A B C D E",
        prose(1, 60), prose(1, 60), prose(1, 60) + " more", prose(2, 40_000), "x " * 200, "the " * 49, "the " * 50,
        "same line\nsame line\n\n \nother line\nsame line", "###***$$$ " * 60, "ÄÖÜ éè 中文 \U0001f600 " * 30,
        "a b c a b c x y z", "nbsp joined words here", "w" * 30_000, "1 2 3 4 5 6 7 8 9 " * 900,
        "tab\tvertical\x0bform\x0cfeed\rreturn", "a|b", "of|and |the|", "﻿mark", "trailing space ",
    ]
    rows = []
    for i, text in enumerate(texts):
        lang = [None, "en", "de", ""][i % 4]
        source = [None, "s1", "s2", "", "s1"][i % 5]
        rows.append((i, text, lang, source, None if i % 3 else len(text or "")))
    for i in range(40):
        rows.append((100 + i, prose(50 + i, 30 + 7 * i), "en", f"s{i % 3}", 5))
    rows += [rows[8], rows[8], rows[2], (None, prose(3, 70), "en", "s1", 1), (None, None, None, None, None)]
    return rows


def documents(spark, rows, extra=True):
    df = spark.createDataFrame(rows, DOCUMENTS)
    if not extra:
        return df
    return df.selectExpr(
        "*", "1 as rank", "true as kept", "'k' as kind", "2 as _row", "3 as copy", "'t' as tokens", "'n' as n_words",
        "4 as id", "5 as rep",
    )


def written(tmp_path, **tables):
    root = tmp_path / uuid.uuid4().hex
    for name, df in tables.items():
        df.coalesce(2).write.parquet(str(root / f"{name}.parquet"))
    return str(root)


def against_sql(spark, name, sf_dir, tables):
    import duckdb

    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet/*.parquet'")
    return difference(QUERIES[name](spark, sf_dir), con, ORACLES[name])


def given(name):
    return duck(name)
