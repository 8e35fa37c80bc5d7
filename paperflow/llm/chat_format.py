"""Chat formatting: heterogeneous conversation layouts to one marked-up string and loss mask.

A record is a row whose columns may hold a prompt, an instruction or a message list. The
nested paths of the fields that a record fills are hashed into its schema fingerprint, which
selects a declarative mapping to canonical turns. The template marks the turns; inside texts
it escapes the characters that begin its control strings, so no text can forge a turn and
``read_back`` returns the exact turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN = "struct<role: string, text: string>"
#: role -> (mark before the text, mark after it). Other roles are named inside the mark.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OPENING = r"(<s>|<<SYS>>|\[INST\]|\[ROLE\][^<\[]*\[TEXT\]|\[NOROLE\])([^<\[]*)"


def turn(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.alias("text"))


def from_list(name: str, role: str, text: str) -> Column:
    return F.transform(name, lambda x: F.struct(x[role].alias("role"), x[text].alias("text")))


#: Filled paths of a layout -> how its turns are read.
MAPPINGS = {
    ("prompt", "completion"): lambda: F.array(turn("user", F.col("prompt")), turn("assistant", F.col("completion"))),
    ("instruction", "output"): lambda: F.array(
        turn("user", F.col("instruction")), turn("assistant", F.col("output"))),
    ("instruction", "input", "output"): lambda: F.array(
        turn("system", F.col("instruction")), turn("user", F.col("input")), turn("assistant", F.col("output"))),
    ("messages[].role", "messages[].content"): lambda: from_list("messages", "role", "content"),
    ("conversations[].from", "conversations[].value"): lambda: from_list("conversations", "from", "value"),
}
#: Columns of a record and their types.
LAYOUT = {
    "prompt": "string", "completion": "string", "instruction": "string", "input": "string", "output": "string",
    "messages": "array<struct<role: string, content: string>>",
    "conversations": "array<struct<from: string, value: string>>",
}


def paths(schema: T.StructType, present: set[str]) -> list[tuple[str, str]]:
    """(column, nested path) of every leaf under the layout columns, sorted."""
    found: list[tuple[str, str]] = []

    def walk(top: str, at: str, kind: T.DataType) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(top, f"{at}.{f.name}", f.dataType)
        elif isinstance(kind, T.ArrayType):
            walk(top, f"{at}[]", kind.elementType)
        else:
            found.append((top, at))

    for f in schema.fields:
        if f.name in present:
            walk(f.name, f.name, f.dataType)
    return sorted(found, key=lambda x: x[1])


def fingerprint_text(of: list[str]) -> str:
    return ",".join(sorted(of))


def fingerprint(records: DataFrame) -> Column:
    """Hash of the nested paths that the record fills (a null column fills none)."""
    leaves = paths(records.schema, set(LAYOUT))
    filled = F.array_compact(F.array(*[F.when(F.col(top).isNotNull(), F.lit(at)) for top, at in leaves]))
    return F.sha2(F.array_join(filled, ","), 256)


def canonical_turns(records: DataFrame) -> DataFrame:
    """Adds ``schema_sha256`` and ``turns``. A layout without a mapping gives null turns."""
    for name, kind in LAYOUT.items():
        if name not in records.columns:
            records = records.withColumn(name, F.lit(None).cast(kind))
    records = records.withColumn("schema_sha256", fingerprint(records))
    turns = F.lit(None).cast(f"array<{TURN}>")
    for of, read in MAPPINGS.items():
        turns = F.when(F.col("schema_sha256") == F.sha2(F.lit(fingerprint_text(of)), 256),
                       read().cast(f"array<{TURN}>")).otherwise(turns)
    filled = F.transform(turns, lambda x: F.struct(x["role"].alias("role"), F.coalesce(x["text"], F.lit("")).alias("text")))
    return records.withColumn("turns", filled)


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def unescape(text: Column) -> Column:
    """Pairs of backslashes first, left to right; what lies between them has only \\l and \\b."""
    part = lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("["))
    return F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")


def pieces_of(x: Column) -> Column:
    """Mark, text and mark of one turn, as (text, loss) pieces; only assistants' texts count for the loss."""
    role = x["role"]
    before = F.concat(F.lit("[ROLE]"), escape(role), F.lit("[TEXT]"))
    after = F.lit("[/ROLE]")
    for name, (a, b) in MARKS.items():
        before, after = F.when(role == name, F.lit(a)).otherwise(before), F.when(role == name, F.lit(b)).otherwise(after)
    before = F.when(role.isNull(), F.lit("[NOROLE]")).otherwise(before)
    piece = lambda t, loss: F.struct(t.alias("text"), loss.alias("loss"))
    return F.array(piece(before, F.lit(False)), piece(escape(x["text"]), F.coalesce(role == "assistant", F.lit(False))),
                   piece(after, F.lit(False)))


def format_chats(records: DataFrame) -> DataFrame:
    """Adds ``schema_sha256``, ``turns``, ``pieces`` and ``formatted``.

    ``formatted`` is the concatenation of the pieces' texts; the loss mask is the pieces' ``loss``.
    Null texts count as empty; a null role has its own mark; records without turns, and
    records of an unknown layout, give an empty string. Repeated records are formatted each.
    """
    out = canonical_turns(records)
    none = F.array().cast("array<struct<text: string, loss: boolean>>")
    out = out.withColumn("pieces", F.coalesce(F.flatten(F.transform("turns", pieces_of)), none))
    return out.withColumn("formatted", F.array_join(F.col("pieces.text"), ""))


def read_back(formatted: Column) -> Column:
    """Turns of a formatted string: array of (role, text), unescaped."""
    marks, texts = (F.regexp_extract_all(formatted, F.lit(OPENING), F.lit(k)) for k in (1, 2))

    def role(mark: Column) -> Column:
        named = unescape(F.substring(mark, F.lit(7), F.length(mark) - 12))  # between [ROLE] and [TEXT]
        out = F.when(mark == "[NOROLE]", F.lit(None).cast("string")).otherwise(named)
        for name, (a, _) in MARKS.items():
            out = F.when(mark == a, F.lit(name)).otherwise(out)
        return out

    return F.zip_with(marks, texts, lambda m, t: F.struct(role(m).alias("role"), unescape(t).alias("text")))


def records_of(turns: DataFrame) -> DataFrame:
    """Records from a table (conv_id, turn, role, text), in the layouts that training sets use.

    A conversation's turns are ordered by turn, then role and text (ties, null first). A user
    and an assistant turn make a prompt record, with a system turn before them an instruction
    record, all else a message list. One conversation is one record and so one row.
    """
    t = turns.select("conv_id", F.struct(
        "turn", "role", F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    each = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    roles = F.array_join(F.transform("t", lambda x: F.coalesce(x["role"], F.lit("?"))), ",")
    each = each.withColumn("_kind", F.when(F.size("t") <= 3, roles).otherwise(F.lit("")))
    text = lambda k: F.get("t", F.lit(k))["text"]
    pair, triple = F.col("_kind") == "user,assistant", F.col("_kind") == "system,user,assistant"
    return each.select(
        "conv_id", F.when(pair, text(0)).alias("prompt"), F.when(pair, text(1)).alias("completion"),
        F.when(triple, text(0)).alias("instruction"), F.when(triple, text(1)).alias("input"),
        F.when(triple, text(2)).alias("output"),
        F.when(~pair & ~triple, F.transform("t", lambda x: F.struct(
            x["role"].alias("role"), x["text"].alias("content")))).alias("messages"))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read from the output."""
    back = formatted.withColumns({
        "_turns": read_back(F.col("formatted")),
        "_loss": unescape(F.array_join(F.transform(
            F.filter("pieces", lambda p: p["loss"]), lambda p: p["text"]), ""))})
    lines = F.array_join(F.transform("_turns", lambda x: F.concat(
        F.coalesce(x["role"], F.lit("")), F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "schema_sha256")
