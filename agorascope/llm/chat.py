"""Chat formatting with typed content parts, in DataFrame functions only.

A turn becomes <|turn|>ROLE<|text|>CONTENT<|end|>. A visitor flattens its parts in order: text as it is, image, audio and
document parts as placeholders <|image TURN.PART|>, whose references and expanded token counts are kept as attachments.
Control strings inside roles and texts are escaped: each backslash is doubled and a backslash is put after the first
character of what looks like a control string, so no text can forge one, and unescape() gives the text back.

The loss mask is the list of [start, end) spans (code points of the formatted string) of the assistant's contents.

Turns are ordered by turn, role and content, nulls first; null roles and texts count as empty; a null conversation id is
one conversation; repeated rows are repeated turns; other columns are not used; an empty table gives no rows. A
conversation is one row of the result, so it has to fit an executor, as a single document has to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = r"<(?=\||/?s>)|\[(?=/?INST\])"
PART = "array<struct<type:string,text:string,ref:string,units:long>>"
#: Tokens for each unit (tile of an image, second of audio, page of a document) of a placeholder.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 600}


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"\\", r"\\\\"), CONTROL, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def text_parts(text: Column) -> Column:
    """A text column as typed parts."""
    none = F.lit(None).cast("string")
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text.cast("string"), F.lit("")).alias("text"), none.alias("ref"), F.lit(None).cast("long").alias("units"))).cast(PART)


def flatten(parts: Column, turn: Column) -> Column:
    """The content of a turn's parts: escaped texts and placeholders in order. Parts of an unknown type are texts."""
    def visit(p: Column, i: Column) -> Column:
        mark = F.concat(F.lit("<|"), p["type"], F.lit(" "), turn.cast("string"), F.lit("."), i.cast("string"), F.lit("|>"))
        return F.when(p["type"].isin(*UNIT_TOKENS), mark).otherwise(escape(p["text"]))

    return F.array_join(F.transform(F.coalesce(parts, F.array().cast(PART)), visit), "")


def attachments(parts: Column, turn: Column) -> Column:
    """(turn, part, type, ref, tokens) of the parts that are no text."""
    tokens = lambda p: F.coalesce(p["units"], F.lit(1)) * sum((F.when(p["type"] == t, F.lit(n)).otherwise(F.lit(0)) for t, n in UNIT_TOKENS.items()), F.lit(0))
    every = F.transform(F.coalesce(parts, F.array().cast(PART)), lambda p, i: F.struct(turn.alias("turn"), i.alias("part"), p["type"].alias("type"), p["ref"].alias("ref"), tokens(p).cast("long").alias("tokens")))
    return F.filter(every, lambda a: a["type"].isin(*UNIT_TOKENS))


def format_chat(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", content_col: str = "text") -> DataFrame:
    """conv_id, formatted, loss (spans), attachments, attachment_tokens per conversation. content_col: a text or PART array.

    One shuffle, by conversation: the running positions and the grouping share it."""
    content = F.col(content_col)
    if not dict(turns.dtypes)[content_col].startswith("array"):
        content = text_parts(content)
    rows = turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), content.cast(PART).alias("parts"))
    rows = rows.withColumns({"content": flatten(F.col("parts"), F.col("turn")), "held": attachments(F.col("parts"), F.col("turn"))}).drop("parts")
    rows = rows.withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)))
    whole = F.length("head") + F.length("content") + len(END)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "content")
    rows = rows.withColumns({"rank": F.row_number().over(order), "begin": F.sum(whole).over(order.rowsBetween(Window.unboundedPreceding, 0)) - whole})
    span = F.when(F.col("role") == "assistant", F.struct((F.col("begin") + F.length("head")).alias("start"), (F.col("begin") + F.length("head") + F.length("content")).alias("end")))
    packed = F.sort_array(F.collect_list(F.struct("rank", F.concat("head", "content", F.lit(END)).alias("piece"), span.alias("span"), "held")))
    found = rows.groupBy("conv_id").agg(packed.alias("all"))
    return found.select("conv_id", F.array_join("all.piece", "").alias("formatted"), F.filter("all.span", lambda s: s.isNotNull()).alias("loss"), F.flatten("all.held").alias("attachments")).withColumn("attachment_tokens", F.aggregate("attachments.tokens", F.lit(0).cast("long"), lambda a, x: a + x))


def parse(formatted: Column) -> Column:
    """The turns of a formatted string: array of (role, text), unescaped; placeholders stay in the text."""
    pieces = F.split(formatted, r"<\|end\|>", -1)
    own = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    halves = F.transform(own, lambda p: F.split(F.substring(p, len(TURN) + 1, 2**31 - 1), r"<\|text\|>", 2))
    return F.transform(halves, lambda h: F.struct(unescape(h[0]).alias("role"), unescape(h[1]).alias("text")))


def masked(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def digest(chats: DataFrame) -> DataFrame:
    """What a reader of the formatted strings and their masks gets back."""
    rows = chats.withColumns({"turns": parse(F.col("formatted")), "loss_text": masked(F.col("formatted"), F.col("loss"))})
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
