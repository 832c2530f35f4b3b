"""References of languages: which documents count, and how their words are spelled."""

from mirrorflow.llm import quality
from pyspark.sql import functions as F


def test_documents_of_fifty_words_count_whatever_stands_around_them(spark):
    texts = ["\n a" * 50, "a \t" * 50, "b " * 49, " " + "c " * 49 + " \r\n", None, "", "É" * 3000, "ΟΔΟΣ " * 50]
    docs = spark.createDataFrame([("x", t) for t in texts], "lang string, text string")
    limits = quality.Limits(min_reference_words=1)
    found = quality.language_references(docs, F.col("lang"), F.col("text"), limits)
    row = found.first()
    assert row["common"] == ["a", "οδος"]
    assert row["word_shares"][1:] == [100 / 150, 50 / 150]
    assert "lower(word" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_repeated_windows_are_sorted_without_a_comparator(spark):
    texts = ["a b c " * 20, "x y z é " + "p q r s é x y z é t", "one two three four", "k k k k", "a b", "", None]
    docs = spark.createDataFrame([(i, "x", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    found = quality.quality_rules(docs)
    assert "array_sort(" not in found._jdf.queryExecution().optimizedPlan().toString()
    again = {r.doc_id: r.n_repeat_words for r in found.collect()}
    assert again == {0: 60, 1: 8, 2: 0, 3: 4, 4: 0, 5: 0, 6: 0}
