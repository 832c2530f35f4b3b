r"""Chat formatting in budgeted windows of whole turns.

A turn is written as ``### role:``, a line feed, its text, ``</turn>`` and a line feed. Control strings
inside texts are broken up by a backslash, as is every backslash, so that ``</turn>`` and ``###`` only
ever mark turns; taking away each backslash that precedes a character restores the text.

Prefix sums of the turns' token counts are cut at even steps. The turns that end within a step form a
window. The step is half of what the system turn and the history leave of the budget, so a
window with the turn that reaches over its edge still fits. A turn longer than a step gets a
window of its own and only such a turn can exceed the budget; turns are never cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorflow.llm.text import prefix_sums

BEGIN, MIDDLE, END = "### ", ":\n", "</turn>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\|#(?=##)|<(?=/turn>)", r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def read_turns(formatted: Column) -> Column:
    """Roles and texts, unescaped, of the turns of a formatted window."""
    pieces = F.split(formatted, END)
    head = r"(?s)^### ((?:[^\\:]++|\\.)*+):\n(.*)$"
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            unescape(F.regexp_extract(p, head, 1)).alias("role"),
            unescape(F.regexp_extract(p, head, 2)).alias("text"),
        ),
    )


def chat_windows(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    budget: int = 1024,
    history_turns: int = 2,
    history_budget: int = 256,
) -> DataFrame:
    """Windows of each conversation: ``conv_id``, ``window``, ``formatted``, ``loss_spans``,
    ``n_repeated`` and ``n_tokens``.

    A first turn with role 'system' starts every window. Up to ``history_turns`` turns, of
    ``history_budget`` tokens together at most, are repeated from before the window. The leading
    ``n_repeated`` turns are such repeats; ``loss_spans`` (code points, end exclusive) covers the escaped
    texts of the other assistant turns. A token is four bytes of the formatted turn, rounded up.
    Turns are ordered by turn number, role and text, nulls first. Null roles and texts are empty; rows
    with a null conversation form one conversation. Repeated rows are turns of their own. Other
    columns are not looked at; an empty table gives an empty table.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(BEGIN), F.regexp_replace(escape(role), ":", r"\\:"), F.lit(MIDDLE))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"), F.col(text_col).alias("text"),
    )
    rows = rows.withColumn("idx", F.row_number().over(order)).select(
        "conv_id", "turn", "role", "text", "idx", head.alias("head"), escape(text).alias("body")
    )
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(END))).withColumns(
        {
            "tokens": F.ceil(F.octet_length("piece") / 4).cast("long"),
            "system": (F.col("idx") == 1) & (role == "system"),
        }
    )
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns(
        {
            "used": F.sum(F.when(~F.col("system"), F.col("tokens")).otherwise(0)).over(running),
            "fixed": F.first(F.when(F.col("system"), F.col("tokens")), ignorenulls=True).over(running),
            "lead_piece": F.first(F.when(F.col("system"), F.col("piece")), ignorenulls=True).over(running),
        }
    )
    free = F.lit(budget - history_budget) - F.coalesce("fixed", F.lit(0))
    rows = rows.withColumn("step", F.greatest(F.lit(1), F.floor(free / 2)).cast("long"))
    rows = rows.withColumns(
        {"cell": F.floor((F.col("used") - 1) / F.col("step")), "big": F.col("tokens") > F.col("step")}
    )
    before = F.lag("cell").over(order)
    opens = ~F.col("system") & (
        (F.col("idx") == 1) | F.lag("system").over(order) | (F.col("cell") != before)
        | F.col("big") | F.lag("big").over(order)
    )
    rows = rows.withColumn("opens", F.coalesce(opens, F.lit(False)))
    rows = rows.withColumn(
        "window", F.greatest(F.lit(0), F.sum(F.col("opens").cast("long")).over(running) - 1)
    )
    repeats = []
    for back in range(1, history_turns + 1):
        upto = F.lead("used", back - 1).over(order) if back > 1 else F.col("used")
        fits = upto - F.col("used") + F.col("tokens") <= history_budget
        again = F.lead("opens", back).over(order) & fits & ~F.col("system")
        repeats.append(F.when(again, F.lead("window", back).over(order)))
    rows = rows.withColumn("repeats", F.array(*repeats) if repeats else F.array().cast("array<bigint>"))
    rows = rows.withColumn(
        "lead_piece", F.when(F.col("opens") & (F.col("window") > 0), F.col("lead_piece"))
    )
    rows = rows.withColumn("own", F.struct("window", F.lit(True).alias("fresh")))
    again = F.transform(
        F.filter("repeats", lambda w: w.isNotNull()),
        lambda w: F.struct(w.alias("window"), F.lit(False).alias("fresh")),
    )
    placed = rows.select(
        "conv_id", "idx", "piece", "tokens", "lead_piece", "fixed",
        F.char_length("head").alias("head"), F.char_length("body").alias("body"),
        (role == "assistant").alias("answer"),
        F.explode(F.concat(F.array("own"), again)).alias("at"),
    )
    part = F.struct("idx", "at.fresh", "piece", "head", "body", "answer")
    windows = placed.groupBy("conv_id", F.col("at.window").alias("window")).agg(
        F.sort_array(F.collect_list(part)).alias("parts"),
        F.max(F.when(F.col("at.fresh"), F.col("lead_piece"))).alias("lead"),
        F.max(F.when(F.col("at.fresh") & F.col("lead_piece").isNotNull(), F.col("fixed"))).alias("lead_tokens"),
        F.sum("tokens").alias("tokens"),
    )
    windows = windows.withColumn("lead", F.coalesce("lead", F.lit("")))
    windows = windows.withColumn(
        "ends", F.transform("parts", lambda p: F.char_length(p["piece"]).cast("long"))
    ).withColumn("ends", prefix_sums(F.col("ends")))
    span = F.transform(
        "parts",
        lambda p, i: F.struct(
            (F.char_length("lead") + F.get("ends", i) - F.char_length(p["piece"]) + p["head"]).alias("start"),
            p["body"].alias("n"),
            (p["fresh"] & p["answer"] & (p["body"] > 0)).alias("counts"),
        ),
    )
    return windows.withColumn("spans", F.filter(span, lambda s: s["counts"])).select(
        "conv_id",
        "window",
        F.concat("lead", F.array_join(F.transform("parts", lambda p: p["piece"]), "")).alias("formatted"),
        F.transform(
            "spans", lambda s: F.struct(s["start"].alias("start"), (s["start"] + s["n"]).alias("end"))
        ).alias("loss_spans"),
        (F.size(F.filter("parts", lambda p: ~p["fresh"])) + (F.col("lead") != "").cast("int")).alias("n_repeated"),
        (F.col("tokens") + F.coalesce("lead_tokens", F.lit(0))).alias("n_tokens"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from the formatted windows alone: ``n_turns``, ``turns`` (role, line feed,
    text, line feed for each turn once), ``loss`` (all text under the mask, unescaped) and
    ``formatted_chars``."""
    fresh = F.slice("turns", F.col("n_repeated") + 1, F.size("turns"))
    read = windows.withColumn("turns", read_turns(F.col("formatted"))).withColumn("turns", fresh)
    read = read.select(
        "conv_id",
        F.struct(
            "window",
            F.array_join(
                F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
            ).alias("turns"),
            F.array_join(
                F.transform(
                    "loss_spans",
                    lambda s: unescape(
                        F.substring("formatted", s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))
                    ),
                ),
                "",
            ).alias("loss"),
        ).alias("part"),
        F.size("turns").alias("n"),
        F.char_length("formatted").alias("chars"),
    )
    read = read.groupBy("conv_id").agg(
        F.sort_array(F.collect_list("part")).alias("parts"),
        F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
    )
    return read.select(
        "conv_id",
        "n_turns",
        F.array_join(F.transform("parts", lambda p: p["turns"]), "").alias("turns"),
        F.array_join(F.transform("parts", lambda p: p["loss"]), "").alias("loss"),
        "formatted_chars",
    )
