"""Chat formatting of typed content parts, all in DataFrame functions.

A turn's content is an ordered list of parts: text, image, audio or document. A visitor over
the list writes text escaped and each attachment as a placeholder, and records the
attachment's reference and the tokens that its placeholder stands for. Rendered::

    <|turn|> user <|body|> See  <|image|>  here. <|end|>

Control strings inside roles and texts get one more backslash in front (before the
backslashes that are there already), so a control string without one is always the template's,
and taking one backslash off restores the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm import common as C

KINDS = ("image", "audio", "document")
CONTROL = r"(<\|(?:turn|body|end|image|audio|document)\|>|</?s>|\[/?INST\])"
TURN, BODY, END = "<|turn|> ", " <|body|> ", " <|end|>\n"
#: Tokens that a placeholder stands for: per image patch (side in pixels), second of audio, document page.
PATCH, PER_SECOND, PER_PAGE = 14, 25, 512

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def text_part(text: Column) -> Column:
    """A plain text as a list with one text part (null: empty)."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text.cast("string"), F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
                            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<!\\)(\\*+)" + CONTROL, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<!\\)\\(\\*+)" + CONTROL, "$1$2")


def _tokens(p: Column) -> Column:
    """Expanded token count of an attachment; unknown sizes count nothing."""
    n = (F.when(p["type"] == "image", F.ceil(p["width"] / PATCH) * F.ceil(p["height"] / PATCH))
         .when(p["type"] == "audio", F.ceil(p["seconds"] * PER_SECOND)).when(p["type"] == "document", p["pages"] * PER_PAGE))
    return F.coalesce(n, F.lit(0)).cast("long")


def _visit(p: Column) -> Column:
    """One part as it stands in the body: a placeholder, or escaped text (also for unknown types)."""
    known = F.when(p["type"] == KINDS[0], F.lit(f" <|{KINDS[0]}|> "))
    for kind in KINDS[1:]:
        known = known.when(p["type"] == kind, F.lit(f" <|{kind}|> "))
    return known.otherwise(escape(F.coalesce(p["text"], F.lit(""))))


def format_chat(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts",
                learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, loss_mask, loss_spans, attachments, expanded_tokens``.

    ``loss_mask`` has a boolean per turn (role ``learn``), ``loss_spans`` the (start, length) in
    code points of those bodies in ``formatted``; ``attachments`` lists (turn, part, type, ref,
    tokens) in placeholder order. Turns are ordered by turn (nulls first), then role, then body, so
    ties and repeated rows have one order; all rows are kept. Null roles, texts and part lists are
    empty; a null conversation id is a conversation of its own; adjacent text parts run together; an
    empty table gives no row; other columns are not read.

    One shuffle, by conversation. A conversation is one text, so its rows do meet in one row;
    its offsets come from a window sum, not from a fold over the list.
    """
    col = lambda c: F.col(f"`{c}`")
    base = rows.select(col(conv_col).alias("conv_id"), col(turn_col).alias("turn"), F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.filter(col(parts_col), lambda p: p.isNotNull()), F.array().cast(f"array<{PART}>")).alias("parts"))
    base = base.select("conv_id", "turn", "role", "parts", F.array_join(F.transform("parts", _visit), "").alias("body"))
    before, after = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY)), F.lit(END)
    size = F.length(before) + F.length("body") + len(END)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "body", F.to_json("parts"))
    nth = F.row_number().over(order) - 1
    start = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")) + F.length(before)
    held = F.filter("parts", lambda p: p["type"].isin(*KINDS))
    turn = base.select("conv_id", F.struct(
        nth.alias("n"), (F.col("role") == learn).alias("learn"), start.alias("start"), F.length("body").cast("long").alias("length"),
        F.concat(before, "body", after).alias("text"),
        F.transform(held, lambda p, i: F.struct(nth.alias("turn"), i.alias("part"), p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens"))).alias("held"),
    ).alias("t"))
    conv = turn.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return conv.select(
        "conv_id", F.size("ts").cast("long").alias("n_turns"), F.array_join(F.col("ts.text"), "").alias("formatted"), F.col("ts.learn").alias("loss_mask"),
        F.transform(F.filter("ts", lambda t: t["learn"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss_spans"),
        F.flatten("ts.held").alias("attachments"),
        F.aggregate(F.flatten("ts.held"), F.lit(0).cast("long"), lambda a, p: a + p["tokens"]).alias("expanded_tokens"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text as ``array<struct<role, text>>``: placeholders taken out, texts unescaped."""
    turns = F.filter(F.split(formatted, r"(?<!\\)<\|turn\|> "), lambda t, i: i > 0)

    def one(t: Column) -> Column:
        halves = F.split(t, r" <\|body\|> ", 2)
        body = F.regexp_replace(F.get(halves, F.lit(1)), r" <\|end\|>\n\z", "")
        text = F.regexp_replace(body, " <\\|(?:" + "|".join(KINDS) + ")\\|> ", "")
        return F.struct(unescape(F.get(halves, F.lit(0))).alias("role"), unescape(text).alias("text"))

    return F.transform(turns, one)


def digests(chats: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` read from formatted texts."""
    turns = parse(F.col("formatted"))
    read = chats.select("conv_id", "formatted", "loss_mask", turns.alias("turns"))
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("turns", lambda t, i: F.get("loss_mask", i)), lambda t: t["text"]), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"),
                       F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def round_trip(rows: DataFrame, **columns: str) -> DataFrame:
    """Format, write to the shared folder, read back and digest."""
    return digests(C.written(format_chat(rows, **columns), "chats"))
