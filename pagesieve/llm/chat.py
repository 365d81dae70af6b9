"""Chat formatting in budgeted windows. DataFrame functions only.

A turn is written as ``<|role|>``, a line break, the text, ``<|end|>`` and a line
break. Control strings inside roles and texts get a backslash after their first
character, backslashes are doubled; both are undone from left to right.

Running sums of turn tokens cut a conversation into spans of whole turns. Every
window shows the system turn, a limited history and its span; only the span's
assistant texts are under the loss mask, so each is a target once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Control strings of this and of other common templates.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
END = "<|end|>\n"
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"
BUDGET, HISTORY_TOKENS, HISTORY_TURNS, TURN_TOKENS = 512, 128, 2, 4
# Tokens for the budget: runs of letters and digits, and every other sign.
TOKEN = r"[\p{L}\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]"


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _rows(turns: DataFrame) -> DataFrame:
    """One row per turn with its place, written parts, tokens and the tokens up to it."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return (
        rows.withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)).cast("long") + TURN_TOKENS)
        .withColumn("at", F.row_number().over(in_order))
        .withColumn("upto", F.sum("tokens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .select(
            "conv_id",
            F.struct(
                "at",
                "role",
                "tokens",
                "upto",
                F.concat(F.lit("<|"), escaped(F.col("role")), F.lit("|>\n")).alias("head"),
                escaped(F.col("text")).alias("body"),
            ).alias("t"),
        )
    )


def _starts(budget: int, history_tokens: int) -> Column:
    """First places of the spans: a span ends before the turn whose running sum passes its room."""
    system = F.when(F.col("turns")[0]["role"] == SYSTEM_ROLE, F.col("turns")[0]["tokens"]).otherwise(0)
    room = F.greatest(F.lit(budget - history_tokens) - system, F.lit(history_tokens))

    def step(state: Column, t: Column) -> Column:
        passes = (t["upto"] - state["base"] > room) & (t["at"] > state["first"])
        return F.struct(
            F.when(passes, t["at"]).otherwise(state["first"]).alias("first"),
            F.when(passes, t["upto"] - t["tokens"]).otherwise(state["base"]).alias("base"),
            F.when(passes, F.concat(state["starts"], F.array(t["at"]))).otherwise(state["starts"]).alias("starts"),
        )

    begin = F.struct(F.lit(1).alias("first"), F.lit(0).cast("long").alias("base"), F.array(F.lit(1)).alias("starts"))
    return F.aggregate("turns", begin, step, lambda s: s["starts"])


def windows(turns: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """conv_id, window, n_repeated, formatted, loss (start, length in formatted) for every window.

    ``turns``: conv_id, turn, role, text; other columns are ignored. Turns are taken
    by turn number (null first), then role and text, so ties and repeated rows have
    one order. Null roles and texts are empty. Rows without conv_id are one
    conversation. A turn longer than the budget is a span of its own, whole. The
    system turn is the first turn, if its role says so. An empty table has no window.
    """
    talks = _rows(turns).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    cut = talks.withColumn("starts", _starts(budget, history_tokens))

    def window(start: Column, k: Column) -> Column:
        last = F.coalesce(F.try_element_at("starts", (k + 2).cast("int")), F.size("turns") + 1)
        first_free = F.when(F.col("turns")[0]["role"] == SYSTEM_ROLE, 2).otherwise(1)
        one, two = (
            (start - n >= first_free)
            & (F.try_element_at("turns", start - 1)["upto"] - F.try_element_at("turns", start - n)["upto"] + F.try_element_at("turns", start - n)["tokens"] <= history_tokens)
            for n in (1, 2)
        )
        back = F.when((k > 0) & two, 2).when((k > 0) & one, 1).otherwise(0)
        system = F.when((k > 0) & (F.col("turns")[0]["role"] == SYSTEM_ROLE), 1).otherwise(0)
        shown = F.concat(F.slice("turns", F.lit(1), system), F.slice("turns", F.greatest(start - back, F.lit(1)), last - start + back))
        return F.struct(k.alias("window"), (system + back).alias("n_repeated"), shown.alias("shown"))

    each = cut.select("conv_id", F.inline(F.transform("starts", window)))

    def place(state: Column, t: Column) -> Column:
        target = (t["role"] == TARGET_ROLE) & (state["seen"] >= F.col("n_repeated"))
        span = F.struct((state["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length"))
        return F.struct(
            (state["at"] + F.length(t["head"]) + F.length(t["body"]) + len(END)).alias("at"),
            (state["seen"] + 1).alias("seen"),
            F.when(target, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    begin = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("seen"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")
    )
    written = F.array_join(F.transform("shown", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    return each.select(
        "conv_id",
        F.col("window").cast("int").alias("window"),
        "n_repeated",
        written.alias("formatted"),
        F.aggregate("shown", begin, place, lambda s: s["spans"]).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The digest columns of each conversation, taken from its windows alone."""
    parts = F.split("formatted", r"<\|end\|>\n")
    new = F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated"))

    def turn(part: Column) -> Column:
        role, text = (F.regexp_extract(part, r"(?s)^<\|(.*?)\|>\n(.*)$", n) for n in (1, 2))
        return F.concat(unescaped(role), F.lit("\n"), unescaped(text), F.lit("\n"))

    masked = F.transform("loss", lambda s: unescaped(F.substring("formatted", s["start"] + 1, s["length"])))
    rows = formatted.select(
        "conv_id",
        F.struct(
            "window",
            F.size(new).cast("long").alias("n"),
            F.array_join(F.transform(new, turn), "").alias("turns"),
            F.array_join(masked, "").alias("loss"),
            F.length("formatted").cast("long").alias("chars"),
        ).alias("w"),
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("w"))
    total = lambda name: F.aggregate(f"w.{name}", F.lit(0).cast("long"), lambda s, n: s + n)
    turns, loss = F.array_join("w.turns", ""), F.array_join("w.loss", "")
    return whole.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )
