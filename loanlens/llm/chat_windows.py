"""Chat formatting in budgeted windows, with built-in SQL functions only.

Prefix sums of turn tokens cut each conversation into spans of whole turns. Every window holds the
system turn, the last turns of the span before it as far as the history budget goes, and its own span. Repeated turns
are marked as such and are outside the loss mask, so each assistant text is learned once.

    <|start|>ROLE<|sep|>TEXT<|end|>      a turn for the first time
    <|again|>ROLE<|sep|>TEXT<|end|>      the system turn or history, repeated

Inside roles and texts a backslash doubles, and one is put into every control string (this template's and the
common ones of ``CONTROL``), so no text can end its turn; ``unescape`` takes them out again.

A turn goes to the span in which it ends: span ``k`` holds the turns whose tokens end in ``(k * stride, (k + 1) * stride]``, with
``stride = (budget - system - history) / 2``. A window then fits the budget unless one of its turns is longer
than the stride; such a turn stays whole. The system turn is always repeated whole: one that leaves no room in the budget puts every
turn into a window of its own. Work is by window functions over ``conv_id``; a conversation's turns stream
through its partition and are never gathered in one row. A window, which the budget bounds, is one row.

Defined results: null roles and texts count as ''; turns of equal number follow by role, then text; a null conv_id is
one conversation; the system turn is the first turn, if its role is ``system``; a conversation of only that turn
is one window; repeated rows are turns of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUDGET, HISTORY = 512, 96
BYTES_PER_TOKEN = 4
TURN_OVERHEAD = 4
START, AGAIN, SEP, END = "<|start|>", "<|again|>", "<|sep|>", "<|end|>"
# Control strings that are broken up, this template's (<|) first.
CONTROL = r"<(?=\|)|<(?=/?s>)|<(?=</?SYS>>)|\[(?=/?INST\])"


def escape(text: Column) -> Column:
    """Reversible: no control string is left."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def token_count(text: Column) -> Column:
    """Words by white space or a token for ``BYTES_PER_TOKEN`` bytes, whichever are more, and the turn's own marks: a cheap
    bound on the order of a tokenizer's count, also for text without spaces."""
    by_bytes = F.ceil(F.octet_length(text) / BYTES_PER_TOKEN).cast("int")
    return F.greatest(F.size(F.split(text, r"\s+")), by_bytes) + TURN_OVERHEAD


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """``conv_id, window, formatted, loss``: one row a window of ``turns(conv_id, turn, role, text)``.

    ``loss`` is the mask: ``array<struct<start, length>>`` in code points of ``formatted``, the escaped texts of
    the assistant turns that this window holds for the first time.
    """
    by_turn = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = by_turn.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy("conv_id")
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("tokens", token_count(F.col("text")))
    rows = rows.withColumn("n", F.row_number().over(by_turn))
    rows = rows.withColumn("is_system", (F.col("n") == 1) & (F.col("role") == "system"))
    body = F.when(F.col("is_system"), F.lit(0)).otherwise(F.col("tokens"))
    system = F.sum(F.when(F.col("is_system"), F.col("tokens")).otherwise(F.lit(0))).over(so_far)
    rows = rows.withColumn("end", F.sum(body).over(so_far)).withColumn("stride", F.greatest(F.lit(1), F.floor((F.lit(budget - history) - system) / 2)))
    rows = rows.withColumn("span", F.when(~F.col("is_system"), F.floor((F.col("end") - 1) / F.col("stride"))))
    new = F.col("span").isNotNull() & ~F.col("span").eqNullSafe(F.lag("span").over(by_turn))
    rows = rows.withColumn("new", new.cast("int"))
    rows = rows.withColumn("window", F.sum("new").over(so_far))  # 0: the system turn
    rows = rows.withColumns(
        {"windows": F.max("window").over(whole), "span_end": F.max("end").over(W.partitionBy("conv_id", "window"))}
    )
    own = F.struct(F.col("window").cast("long").alias("window"), F.lit(1).alias("place"), F.lit(True).alias("first"))
    later = F.struct((F.col("window") + 1).cast("long").alias("window"), F.lit(0).alias("place"), F.lit(False).alias("first"))
    recent = (F.col("span_end") - (F.col("end") - F.col("tokens")) <= history) & (F.col("window") < F.col("windows"))
    uses = F.when(
        F.col("is_system"),
        F.transform(
            F.sequence(F.lit(1).cast("long"), F.greatest(F.col("windows").cast("long"), F.lit(1).cast("long"))),
            lambda w: F.struct(w.alias("window"), F.lit(-1).alias("place"), (w == 1).alias("first")),
        ),
    ).otherwise(F.when(recent, F.array(own, later)).otherwise(F.array(own)))
    used = rows.select("conv_id", "n", "role", "text", F.explode(uses).alias("u"))
    head = F.concat(F.when(F.col("u.first"), F.lit(START)).otherwise(F.lit(AGAIN)), escape(F.col("role")), F.lit(SEP))
    piece = F.struct(
        F.col("u.place").alias("place"), F.col("n").alias("n"), head.alias("head"), escape(F.col("text")).alias("text"),
        (F.col("u.first") & (F.col("role") == "assistant")).alias("target"),
    )
    grouped = used.groupBy("conv_id", F.col("u.window").alias("window")).agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"], F.lit(END))), "")
    loss = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("out")),
        lambda acc, p: F.struct(
            (acc["at"] + F.char_length(p["head"]) + F.char_length(p["text"]) + len(END)).alias("at"),
            F.when(
                p["target"],
                F.concat(
                    acc["out"],
                    F.array(F.struct((acc["at"] + F.char_length(p["head"])).alias("start"), F.char_length(p["text"]).alias("length"))),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return grouped.select("conv_id", "window", formatted.alias("formatted"), loss.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, window, turns, learned, formatted_chars`` from the formatted text and its mask alone.

    ``turns`` has the role and text of every turn that is not marked as repeated, ``learned`` the texts under the mask.
    """
    pieces = F.filter(F.split("formatted", r"<\|end\|>"), lambda p: F.startswith(p, F.lit(START)))
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring(F.substring_index(p, SEP, 1), F.lit(len(START) + 1), F.char_length(p))).alias("role"),
            unescape(F.substring_index(p, SEP, -1)).alias("text"),
        ),
    )
    learned = F.transform("loss", lambda m: unescape(F.substring(F.col("formatted"), m["start"] + 1, m["length"])))
    return formatted.select(
        "conv_id", "window", turns.alias("turns"), learned.alias("learned"), F.char_length("formatted").cast("long").alias("formatted_chars")
    )


def query(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted, and read back from the windows."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    back = read_back(windows(turns.unionByName(extra)))
    part = F.struct(
        "window",
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join("learned", "").alias("learned"),
    )
    whole = back.groupBy("conv_id").agg(
        F.sum(F.size("turns")).cast("long").alias("n_turns"),
        F.array_sort(F.collect_list(part)).alias("parts"),
        F.sum("formatted_chars").cast("long").alias("formatted_chars"),
    )
    text = lambda field: F.array_join(F.col(f"parts.{field}"), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(text("turns"), 256).alias("turns_sha256"),
        F.char_length(text("learned")).cast("long").alias("loss_chars"),
        F.sha2(text("learned"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
