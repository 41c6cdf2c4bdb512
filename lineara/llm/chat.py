"""Operator 6: chat formatting in Spark expressions only.

A conversation's turns are collected, sorted by turn (then role, then text), and adjacent turns of one role are merged
into one block:

    <|im_start|>ROLE\nTEXT<|im_sep|>TEXT<|im_end|>\n

where <|im_sep|> stands between merged turns. Inside texts and roles each "<|" becomes "<\\|" and each "<\\" becomes
"<\\\\", so no control string can stand there and both can be told apart again; a newline in a role becomes "<\\n". The
loss mask is an array of spans (start, length in code points) of the formatted text, one for each assistant text.

Null texts and roles are empty; a null turn comes first; a null conv_id is a conversation; rows with equal turns stand
in the order of role and text, and equal rows stay separate turns; an empty table gives no rows; other columns are
ignored. A conversation becomes one row, so it must fit in a task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of the template; fixed values.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<([|\\])", r"<\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\([|\\])", r"<$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def formatted(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_mask of each conversation."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), empty("role").alias("role"), empty("text").alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        first = (i == 0) | (t["role"] != F.get("turns", i - 1)["role"])
        opening = F.concat(F.when(i == 0, "").otherwise(END + "\n"), F.lit(START), escape_role(t["role"]), F.lit("\n"))
        return F.struct(F.when(first, opening).otherwise(SEP).alias("before"), escape(t["text"]).alias("text"), (t["role"] == loss_role).alias("loss"))

    convs = convs.select("conv_id", F.transform("turns", piece).alias("pieces"))
    text = F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["text"])), ""), F.lit(END + "\n"))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def add(a: Column, p: Column) -> Column:
        start = a["at"] + F.length(p["before"])
        span = F.array(F.struct(start.alias("start"), F.length(p["text"]).cast("long").alias("length")))
        return F.struct((start + F.length(p["text"])).alias("at"), F.when(p["loss"], F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

    return convs.select("conv_id", text.alias("formatted"), F.aggregate("pieces", begin, add, lambda a: a["spans"]).alias("loss_mask"))


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and loss_text, from the formatted texts and masks alone."""
    blocks = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda b: b != "")

    def turns(b: Column) -> Column:
        head = F.substring_index(b, "\n", 1)
        role = unescape_role(F.substring(head, F.lit(len(START) + 1), F.length(head)))
        body = F.substring(b, F.length(head) + 2, F.length(b))
        return F.transform(F.split(body, r"<\|im_sep\|>"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    spans = F.transform("loss_mask", lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return chats.select("conv_id", "formatted", F.flatten(F.transform(blocks, turns)).alias("turns"), F.array_join(spans, "").alias("loss_text"))


def digests(chats: DataFrame) -> DataFrame:
    """What the contract asks for of each conversation, read back from its formatted text."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(chats).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
