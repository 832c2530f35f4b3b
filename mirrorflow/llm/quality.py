"""Quality rules: repetition rules, and divergence from the usual text of a language.

Each document's histogram of character classes, and that of the most common words of its language,
is compared with the histogram of all documents of that language by Jensen-Shannon distance. All
counts are expressions on one row; only the references need a shuffle, of word counts that are
summed before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorflow.llm.text import SPACE, without, words
from mirrorflow.sources.scratch import materialise

WORD = r"[^\x20\x09-\x0D]"
CLASSES = ("lower", "space", "upper", "digit", "punct", "symbol", "other")


@dataclass(frozen=True)
class Limits:
    """Production parameters; distances lie between 0 and 1."""

    common_words: int = 32
    min_words: int = 50
    min_reference_words: int = 1000
    max_class_distance: float = 0.28
    max_word_distance: float = 0.55


def _repeat_positions(df: DataFrame) -> DataFrame:
    """Adds ``_repeats``: sorted start positions of 3-word windows that occur twice or more.

    Windows are first told apart by a 32-bit hash. Where some are equal they are packed with their
    positions, so that one sort of longs brings them together, and compared by their words.
    """

    def window(i: Column) -> list[Column]:
        return [F.get("_words", i + j) for j in range(3)]

    # each word is hashed once, a window by the hashes of its words
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.hash(w)))
    first = F.slice("_hashes", F.lit(1), F.size("_hashes") - 2)
    codes = F.transform(first, lambda h, i: F.hash(h, F.get("_hashes", i + 1), F.get("_hashes", i + 2)))
    df = df.withColumn("_codes", F.when(F.size("_words") >= 3, codes).otherwise(F.array().cast("array<int>")))
    df = df.drop("_hashes")
    packed = F.transform(
        "_codes", lambda h, i: F.shiftleft(h.cast("long"), 32).bitwiseOR(i.cast("long"))
    )
    some = F.size(F.array_distinct("_codes")) < F.size("_codes")
    none = F.array().cast("array<bigint>")
    df = df.withColumn("_sorted", F.when(some, F.sort_array(packed)).otherwise(none)).drop("_codes")

    def code(i: Column) -> Column:
        return F.shiftright(F.get("_sorted", i), 32)

    met = F.filter(
        "_sorted",
        lambda x, i: (F.shiftright(x, 32).eqNullSafe(code(i - 1)))
        | (F.shiftright(x, 32).eqNullSafe(code(i + 1))),
    )
    place = F.transform(met, lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))
    df = df.withColumn("_met", F.when(F.size("_sorted") > 1, place).otherwise(F.array().cast("array<int>")))
    # the natural order of sort_array, not array_sort, which would run a comparator on every pair
    spelled = F.sort_array(
        F.transform("_met", lambda i: F.struct(F.struct(*window(i)).alias("w"), i.alias("i")))
    )
    df = df.withColumn("_spelled", spelled).drop("_sorted", "_met")

    def word(i: Column) -> Column:
        return F.get("_spelled", i)["w"]

    twice = F.filter(
        "_spelled", lambda s, i: s["w"].eqNullSafe(word(i - 1)) | s["w"].eqNullSafe(word(i + 1))
    )
    return df.withColumn("_repeats", F.sort_array(F.transform(twice, lambda s: s["i"]))).drop("_spelled")


def counted(df: DataFrame, text: Column) -> DataFrame:
    """Adds ``_counts``, the character classes of the text by name, and ``_marks``."""
    df = df.withColumn("_rest", F.coalesce(text, F.lit("")))
    patterns = {
        "lower": "[a-z]+", "space": SPACE, "upper": "[A-Z]+", "digit": "[0-9]+",
        "punct": r"""[.,;:!?'"()\-]+""", "symbol": r"[\x21-\x7E]+",
    }
    for name, pattern in patterns.items():
        if name == "symbol":
            marks = F.char_length("_rest") - F.char_length(without(F.col("_rest"), "[#*$%&|<>]+"))
            df = df.withColumn("_marks", marks)
        df = df.withColumn("_left", without(F.col("_rest"), pattern))
        df = df.withColumn(f"_{name}", F.char_length("_rest") - F.char_length("_left"))
        df = df.withColumn("_rest", F.col("_left")).drop("_left")
    counts = F.struct(
        *[F.col(f"_{c}").cast("long").alias(c) for c in patterns],
        F.char_length("_rest").cast("long").alias("other"),
    )
    return df.withColumn("_counts", counts).drop("_rest", *[f"_{c}" for c in patterns])


def language_references(docs: DataFrame, lang: Column, text: Column, limits: Limits) -> DataFrame:
    """Per language the shares of character classes and of its most common lower-cased words.

    Taken over all documents of ``min_words`` words or more. ``common`` is ordered by count, ties by
    spelling; the first entry of ``word_shares`` is the share of all other words. A null language
    is the language ''. Languages with fewer than ``min_reference_words`` words are left out.
    """
    rows = docs.select(F.coalesce(lang, F.lit("")).alias("_lang"), text.alias("_text"))
    if limits.min_words > 0:
        # one anchored match, no further than needed to tell whether there are so many words
        some = rf"\A{SPACE[:-1]}*+(?:{WORD}++{SPACE}+){{{limits.min_words - 1}}}{WORD}"
        rows = rows.filter(F.col("_text").rlike(some))
    rows = rows.filter(F.col("_text").isNotNull())
    classes = counted(rows, F.col("_text")).groupBy("_lang").agg(
        F.array(*[F.sum(F.col(f"_counts.{c}")) for c in CLASSES]).alias("class_sums")
    )
    by_word = (
        rows.select("_lang", F.explode(words(F.lower("_text"))).alias("word"))
        .groupBy("_lang", "word")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    order = Window.partitionBy("_lang").orderBy(F.desc("times"), "word")
    top = (
        by_word.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= limits.common_words)
        .groupBy("_lang")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "word", "times"))).alias("top"))
    )
    totals = by_word.groupBy("_lang").agg(F.sum("times").alias("n"))
    total = F.aggregate("class_sums", F.lit(0).cast("long"), lambda a, x: a + x)
    known = F.aggregate("top", F.lit(0).cast("long"), lambda a, x: a + x["times"])
    return (
        classes.join(top, "_lang")
        .join(totals, "_lang")
        .filter(F.col("n") >= limits.min_reference_words)
        .select(
            "_lang",
            F.transform("class_sums", lambda x: x / total).alias("class_shares"),
            F.transform("top", lambda x: x["word"]).alias("common"),
            F.array_max(F.transform("top", lambda x: F.octet_length(x["word"]))).alias("longest"),
            F.concat(
                F.array((F.col("n") - known) / F.col("n")),
                F.transform("top", lambda x: x["times"] / F.col("n")),
            ).alias("word_shares"),
        )
    )


def _part(p: Column, q: Column) -> Column:
    m = (p + q) / 2
    return p * F.log2(p / m) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)


def _distance(present: Column, share: str, n: Column) -> Column:
    """Jensen-Shannon distance, from the bins that a document has: structs of index and count."""
    seen = F.aggregate(
        present, F.lit(0.0), lambda a, x: a + _part(x["c"] / n, F.get(share, x["i"]))
    )
    covered = F.aggregate(present, F.lit(0.0), lambda a, x: a + F.get(share, x["i"]))
    return F.sqrt(F.greatest(F.lit(0.0), (seen + (F.lit(1.0) - covered)) / 2))


def judged(docs: DataFrame, lang: Column, text: Column, limits: Limits) -> DataFrame:
    """Adds ``_q`` with all counts, distances and verdicts; other columns stay as they are."""
    references = materialise(language_references(docs, lang, text, limits), "language_references")
    df = docs.withColumns({"_lang": F.coalesce(lang, F.lit("")), "_body": F.coalesce(text, F.lit(""))})
    df = df.join(references, "_lang", "left")
    df = counted(df, F.col("_body")).withColumn("_words", words(F.col("_body")))
    df = _repeat_positions(df)
    lines = F.filter(F.split("_body", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    reach = F.transform(
        "_repeats", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_repeats", i + 1) - p, F.lit(3)))
    )
    df = df.withColumns(
        {
            "_lines": lines,
            "_again": F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x),
            "_n": F.size("_words").cast("long"),
            "_chars": F.char_length("_body").cast("long"),
            "_codes": F.transform("_words", lambda w: F.lower(w)),
        }
    ).drop("_words", "_repeats", "_body")
    # most words are longer than any common one, and need no search
    code = F.transform(
        "_codes",
        lambda w: F.when(F.octet_length(w) <= F.col("longest"), F.array_position("common", w).cast("int"))
        .otherwise(0),
    )
    df = df.withColumn("_codes", F.sort_array(F.array_remove(code, 0)))
    ends = F.filter(
        F.sequence(F.lit(0), F.size("_codes") - 1),
        lambda i: ~F.get("_codes", i).eqNullSafe(F.get("_codes", i + 1)),
    )
    df = df.withColumn("_ends", F.when(F.size("_codes") > 0, ends).otherwise(F.array().cast("array<int>")))
    others = F.struct(F.lit(0).alias("i"), (F.col("_n") - F.size("_codes")).cast("int").alias("c"))
    present = F.transform(
        "_ends",
        lambda e, j: F.struct(
            F.get("_codes", e).alias("i"),
            (e - F.coalesce(F.get("_ends", j - 1), F.lit(-1))).alias("c"),
        ),
    )
    classes = F.array(
        *[F.struct(F.lit(i).alias("i"), F.col(f"_counts.{c}").alias("c")) for i, c in enumerate(CLASSES)]
    )
    df = df.withColumns(
        {
            "_present": F.filter(F.concat(F.array(others), present), lambda x: x["c"] > 0),
            "_classes": F.filter(classes, lambda x: x["c"] > 0),
        }
    ).drop("_codes", "_ends")
    enough = F.col("common").isNotNull() & (F.col("_n") >= limits.min_words)
    failed = (F.col("_n") < 50) | (100 * F.col("_again") > 50 * F.col("_n"))
    df = df.withColumns(
        {
            "_by_class": F.when(enough, _distance(F.col("_classes"), "class_shares", F.col("_chars"))),
            "_by_word": F.when(enough, _distance(F.col("_present"), "word_shares", F.col("_n"))),
            "_failed": failed,
        }
    )
    far = (F.col("_by_class") > limits.max_class_distance) | (F.col("_by_word") > limits.max_word_distance)
    result = F.struct(
        F.col("_n").alias("n_words"),
        (F.col("_chars") - F.col("_counts.space")).alias("word_chars"),
        F.col("_marks").cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_again").alias("n_repeat_words"),
        F.col("_failed").alias("base_failed"),
        (~F.col("_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"),
        F.col("_by_class").alias("class_distance"),
        F.col("_by_word").alias("word_distance"),
    )
    # A filter on the verdict must not be pushed below, where it would spell out every step many
    # times over; it stays above a column that is not deterministic.
    df = df.withColumns({"_q": result, "_mark": F.monotonically_increasing_id()})
    return df.select(*docs.columns, F.when(F.col("_mark") >= 0, F.col("_q")).alias("_q"))


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    limits: Limits = Limits(),
) -> DataFrame:
    """Counts, distances and verdict of each row of ``docs``.

    Returns ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``kept``, ``class_distance`` and ``word_distance``. A null text
    is an empty one and fails the base rules; a null language is a language of its own. Distances
    are null, and reject nothing, below ``min_words`` words and for languages without a reference.
    Repeated rows are judged one by one; null ids stay null. Other columns are not looked at.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_body_in"), F.col(lang_col).alias("_lang_in")
    )
    return judged(rows, F.col("_lang_in"), F.col("_body_in"), limits).select(
        F.col("_id").alias("doc_id"), "_q.*"
    )


def clean_documents(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits()
) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(row.alias("_row"))
    out = judged(packed, F.col(f"_row.{lang_col}"), F.col(f"_row.{text_col}"), limits)
    return out.filter("_q.kept").select("_row.*")
