"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted by turn (then role, then text, so ties and
repeated rows have one defined order; null turns first).  Adjacent turns of one role are merged into one
block, and the pieces are aggregated as an array and concatenated:

    <|im_start|>ROLE\\nTEXT<|im_sep|>TEXT<|im_end|>\\n<|im_start|>...

Control strings inside texts are escaped reversibly: ``<`` + k backslashes + ``|`` becomes
``<`` + k+1 backslashes + ``|``, so no text can hold a control string, and taking one backslash away gives
the text back.  In roles a backslash is written ``\\s`` and a line break ``\\n`` before that.

The loss mask lists (start, length) of every text of the trained role in the formatted string, in code
points: separators, roles and marks stay outside.

Null texts and roles count as empty.  Rows with a null conversation id form one conversation.  Empty table:
no rows.  One output row holds one conversation by definition; apart from that row the work is linear in the
turns (positions are a running sum over the exploded array, not a growing accumulator), and everything after
the one shuffle by conversation stays in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, SEP = "<|im_start|>", "<|im_end|>", "<|im_sep|>"
_CLOSE = END + "\n"
PIECE = 1024  # code points


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def format_chat(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", train_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv``, ``formatted``, ``mask`` array<struct<start,length>> (code points).

    Only the four named columns are read; further columns of ``df`` may have any names.
    """
    rows = df.select(F.col(conv).alias("c"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    grouped = rows.groupBy("c").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    turns = F.transform("turns", lambda t, i: F.struct(
        t["role"].alias("role"), escape(t["text"]).alias("text"),
        ((i == 0) | (t["role"] != F.get("turns", i - 1)["role"])).alias("opens"),
        ((i == F.size("turns") - 1) | (t["role"] != F.get("turns", i + 1)["role"])).alias("closes")))
    one = grouped.select("c", F.posexplode(turns).alias("pos", "t")).select("c", "pos", "t.*")
    before = F.when(F.col("opens"), F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))).otherwise(SEP)
    after = F.when(F.col("closes"), F.lit(_CLOSE)).otherwise("")
    one = one.select("c", "pos", "text", (F.col("role") == train_role).alias("train"),
                     before.alias("before"), after.alias("after"))
    size = (F.length("before") + F.length("text") + F.length("after")).cast("long")
    upto = Window.partitionBy("c").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = one.select(
        "c", F.struct("pos", F.concat("before", "text", "after").alias("piece"),
                      (F.coalesce(F.sum(size).over(upto), F.lit(0)) + F.length("before")).alias("start"),
                      F.length("text").cast("long").alias("length"), "train").alias("p"))
    joined = placed.groupBy("c").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    return joined.select(
        F.col("c").alias(conv),
        F.array_join(F.transform("ps", lambda p: p["piece"]), "").alias("formatted"),
        F.transform(F.filter("ps", lambda p: p["train"]),
                    lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"))).alias("mask"))


def read_turns(formatted: Column) -> Column:
    """The turns array<struct<role,text>> that a formatted string holds, unescaped."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda b, i: i > 0)  # nothing stands before the first mark

    def turns(block: Column) -> Column:
        role = _unescape_role(F.substring_index(block, "\n", 1))
        at = F.locate("\n", block) + 1
        body = F.substr(block, at, F.length(block) - at + 1 - len(_CLOSE))
        return F.transform(F.split(body, r"<\|im_sep\|>"),
                           lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, nothing between.

    The string is cut once into pieces of ``PIECE`` code points, so that each entry is looked up in the pieces
    that it lies in: linear in a very long conversation, where positions counted from its start are not.
    """
    def under(pieces: Column, m: Column) -> Column:
        first = F.floor(m["start"] / PIECE)
        many = F.floor((m["start"] + m["length"] - 1) / PIECE) - first + 1
        near = F.array_join(F.slice(pieces, (first + 1).cast("int"), F.greatest(many, F.lit(0)).cast("int")), "")
        return unescape(F.substr(near, (m["start"] - first * PIECE + 1).cast("int"), m["length"].cast("int")))

    # the pieces are bound as a lambda's variable: made once, not once for each entry
    pieces = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return F.element_at(F.transform(F.array(pieces), lambda ps: F.array_join(
        F.transform(mask, lambda m: under(ps, m)), "")), 1)


def digest(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the formatted strings hold, read back from them; the loss text is what lies under ``mask``."""
    turns = formatted.select(conv, read_turns(F.col("formatted")).alias("turns"),
                             masked_text(F.col("formatted"), F.col("mask")).alias("loss"),
                             F.length("formatted").cast("long").alias("formatted_chars"))
    out = turns.select(
        conv, F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"),
        "loss", "formatted_chars")
    return out.select(conv, "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
