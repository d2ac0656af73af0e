"""Chat formatting with typed content parts.

A message's content is a list of parts (``type``, ``text``, ``ref``,
``units``).  A visitor, one handler per type, flattens them to text: text
stands as it is, an image, audio or document part becomes an ordered
placeholder, whose attachment reference and expanded token count are
recorded.  Turns are wrapped in ``<|im_start|>role`` newline, content,
``<|im_end|>`` newline.  Control strings inside roles and texts are escaped
reversibly: wherever ``<`` and ``|`` stand with only backslashes between,
one more backslash goes between them, so no escaped text holds ``<|``, and
taking one out again restores it.

The loss mask is a list of character spans over the formatted text: the
content of each assistant turn, in order.

Turns are rendered before the shuffle; offsets are running sums over a
conversation's turns, and one row per conversation holds its formatted text,
which is as long as the conversation.

Defined cases: a NULL text is empty and a NULL role is the empty role; a NULL
conversation id is a conversation of its own; equal turn numbers are ordered
by role, then text, and all kept; an unknown part type is text; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.llm.common import map_arrow

START, END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLES = ("assistant",)
#: tokens a unit expands to: an image tile, a second of audio, a page
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 600}
PART = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("units", T.IntegerType()),
    ]
)


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<\\$1|")


def escape_role(role: Column) -> Column:
    """Also keeps the header on one line."""
    plain = F.replace(F.coalesce(role, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return escape(F.replace(plain, F.lit("\n"), F.lit("\\n")))


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def text_part(text: Column) -> Column:
    """A content list of one text part."""
    none = F.lit(None).cast("string")
    part = F.struct(F.lit("text").alias("type"), text.alias("text"), none.alias("ref"), F.lit(None).cast("int").alias("units"))
    return F.array(part)


def _placeholder(kind: str) -> Callable[[Column, Column], Column]:
    return lambda part, place: F.concat(F.lit(f"<|{kind}:"), place.cast("string"), F.lit("|>"))


#: the visitor: how an attachment part is written, given the part and its
#: place among the message's attachments; all other parts are text
VISITOR: dict[str, Callable[[Column, Column], Column]] = {
    "image": _placeholder("image"),
    "audio": _placeholder("audio"),
    "document": _placeholder("document"),
}


def _placeholder_of(part: Column, place: Column) -> Column:
    out = F.lit("")
    for kind, handler in VISITOR.items():
        out = F.when(part["type"] == kind, handler(part, place)).otherwise(out)
    return out


def visit(parts: Column) -> Column:
    """The flattened content.  Neighbouring texts are joined before they are
    escaped, as a control string may lie across two of them."""
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("run"), F.lit(0).alias("place"))

    def step(acc: Column, part: Column) -> Column:
        attached = _is_attachment(part)
        flushed = F.concat(acc["done"], escape(acc["run"]), _placeholder_of(part, acc["place"]))
        return F.struct(
            F.when(attached, flushed).otherwise(acc["done"]).alias("done"),
            F.when(attached, F.lit("")).otherwise(F.concat(acc["run"], F.coalesce(part["text"], F.lit("")))).alias("run"),
            F.when(attached, acc["place"] + 1).otherwise(acc["place"]).alias("place"),
        )

    return F.aggregate(parts, start, step, lambda acc: F.concat(acc["done"], escape(acc["run"])))


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["type"].isin(*TOKENS_PER_UNIT), F.lit(False))


def expanded_tokens(part: Column) -> Column:
    per_unit = F.lit(0)
    for kind, tokens in TOKENS_PER_UNIT.items():
        per_unit = F.when(part["type"] == kind, F.lit(tokens)).otherwise(per_unit)
    return (per_unit * F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(1))).cast("long")


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, head, body, attachments, loss`` of each message
    ``(conv_id, turn, role, parts)``; placeholders count within a message."""
    parts = F.coalesce(F.col("parts"), F.array().cast(T.ArrayType(PART)))

    attached = F.transform(
        F.filter(parts, _is_attachment),
        lambda p, i: F.struct(
            i.alias("place"), p["type"].alias("type"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")
        ),
    )
    return messages.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        visit(parts).alias("body"),
        attached.alias("attachments"),
        F.coalesce(F.col("role").isin(*LOSS_ROLES), F.lit(False)).alias("loss"),
    )


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, loss_spans
    (start, end), attachments (turn, place, type, ref, tokens),
    attachment_tokens``."""
    turns = render(messages)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("head") + F.length("body") + len(END)
    turns = turns.withColumn("nth", F.row_number().over(order)).withColumn(
        "at", F.coalesce(F.sum(length.cast("long")).over(before), F.lit(0)) + F.length("head")
    )
    span = F.struct(F.col("at").alias("start"), (F.col("at") + F.length("body")).alias("end"))
    piece = F.struct(
        "nth", F.concat("head", "body", F.lit(END)).alias("piece"), F.when(F.col("loss"), span).alias("span"), "attachments"
    )
    chats = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("t"))
    attachments = F.flatten(
        F.transform("t", lambda p: F.transform(p["attachments"], lambda a: F.struct(p["nth"].alias("turn"), a["place"].alias("place"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))))
    )
    return chats.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda p: p["piece"]), "").alias("formatted"),
        F.filter(F.transform("t", lambda p: p["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )


def parse(formatted: str) -> list[tuple[str, str]]:
    """``(role, text)`` of each turn of a formatted conversation, unescaped."""
    turns = []
    for piece in formatted.split(END)[:-1]:
        head, _, body = piece.removeprefix(START).partition("\n")
        turns.append((unescape_role(head), unescape(body)))
    return turns


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of what ``format_chats`` wrote, from its formatted text and
    loss spans alone: ``conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars``."""
    import hashlib

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist(), strict=True):
                turns, whole = parse(text), hashlib.sha256()
                for role, body in turns:
                    whole.update(f"{role}\n{body}\n".encode())
                loss, chars = hashlib.sha256(), 0
                for s in spans:
                    body = unescape(text[s["start"] : s["end"]])
                    loss.update(body.encode())
                    chars += len(body)
                rows.append((len(turns), whole.hexdigest(), chars, loss.hexdigest(), len(text)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["conv_id", *names]
            )

    schema = T.StructType([chats.schema["conv_id"]]).add("n_turns", "long").add("turns_sha256", "string")
    schema.add("loss_chars", "long").add("loss_sha256", "string").add("formatted_chars", "long")
    return map_arrow(chats.select("conv_id", "formatted", "loss_spans"), task, schema)
