"""Chat formatting with typed content parts.

A turn's content is a list of parts (type, text, ref, tokens). A visitor flattens them in order: a text part is its
escaped text, an image, audio or document part an ordered placeholder such as <|image:2|>; attachments record type,
ordinal, reference and token count, and a turn's expanded tokens are its placeholders' sum. All of this is one row's
expressions in Spark SQL.

The template of a turn is <s>[ROLE]role[/ROLE]content</s>; a conversation is its turns in order. Control strings inside
roles and texts are escaped: a backslash doubles, and after the first character of a control string stands a backslash, so
that no control string is left; a parser drops each single backslash and takes the next character as it is. Assistants'
content is under the loss mask, as one span of code points in each such turn.

Reading back is a fold over rows sorted by conversation and turn, a partition's batches in turn: digests run on, so
a conversation with a third of all rows takes no more memory than one with two. Its digest is one chain, so one task
reads its formatted turns; the formatting before that is spread.

Null texts and roles count as empty. Turns sort by turn (nulls first), then role and text, so ties have one order.
Repeated rows are turns of their own. A null conv_id is a conversation of its own. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import map_batches

#: Fixed control strings: this template's and those of common chat templates.
CONTROL = ["<s>", "</s>", "[ROLE]", "[/ROLE]", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|"]
PARTS = "array<struct<type:string,text:string,ref:string,tokens:int>>"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    """Reversible: see unescape."""
    found = "|".join(re.sub(r"([\[\]<>|/])", r"\\\1", c) for c in sorted(CONTROL, key=len, reverse=True))
    # A match's first character, a backslash, the rest.
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), rf"(?=(?:{found}))(.)", r"$1\\")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def flatten_parts(parts: Column) -> Column:
    """content, attachments and expanded tokens of one turn's parts."""
    kinds = F.transform(parts, lambda p: F.coalesce(p["type"], F.lit("text")))
    other = F.filter(parts, lambda p: F.coalesce(p["type"], F.lit("text")) != "text")
    numbered = F.transform(other, lambda p, i: F.struct(p["type"].alias("type"), (i + 1).alias("ordinal"), p["ref"].alias("ref"), F.coalesce(p["tokens"], F.lit(1)).alias("tokens")))
    place = lambda i: F.size(F.filter(F.slice(kinds, F.lit(1), i + 1), lambda k: k != "text"))
    visit = lambda p, i: F.when(F.coalesce(p["type"], F.lit("text")) == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), p["type"], F.lit(":"), place(i).cast("string"), F.lit("|>")))
    content = F.array_join(F.transform(parts, visit), "")
    return F.struct(content.alias("content"), numbered.alias("attachments"), F.aggregate(numbered, F.lit(0), lambda a, x: a + x["tokens"]).alias("expanded_tokens"))


def text_part(text: Column) -> Column:
    """The parts of a turn that is only text."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens"))).cast(PARTS)


def format_turns(turns: DataFrame, parts: Column, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role") -> DataFrame:
    """conv_id, turn, role, segment (the formatted turn), loss_start, loss_end (code points in it; null: no loss), attachments, expanded_tokens.

    A training text is a conversation's segments in order.
    """
    flat = flatten_parts(F.coalesce(parts, F.array().cast(PARTS)))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), flat.alias("flat"))
    head = F.concat(F.lit("<s>[ROLE]"), escape(F.col("role")), F.lit("[/ROLE]"))
    learned = F.col("role") == LEARNED
    start = F.length(head)
    return rows.select(
        "conv_id", "turn", "role", F.concat(head, "flat.content", F.lit("</s>")).alias("segment"), F.when(learned, start).alias("loss_start"), F.when(learned, start + F.length("flat.content")).alias("loss_end"),
        F.col("flat.attachments").alias("attachments"), F.col("flat.expanded_tokens").alias("expanded_tokens"),
    )


TURN = re.compile(r"<s>\[ROLE\](.*?)\[/ROLE\](.*?)</s>", re.DOTALL)


class Reading:
    """What is read back of one conversation so far."""

    def __init__(self) -> None:
        self.turns, self.chars, self.learned = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int | None, end: int | None) -> None:
        at = 0
        while at < len(segment):
            m = TURN.match(segment, at)
            if m is None:
                raise ValueError("not a formatted turn")
            self.turns += 1
            self.all.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
            at = m.end()
        self.chars += len(segment)
        if start is not None:
            text = unescape(segment[start:end])
            self.learned += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.learned, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of format_turns' output."""
    kind = formatted.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, kind = None, None, None
        for batch in batches:
            done = []
            kind = batch.schema.field("conv_id").type
            convs, segments, starts, ends = (batch.column(batch.schema.get_field_index(c)) for c in ("conv_id", "segment", "loss_start", "loss_end"))
            for i in range(batch.num_rows):
                conv = convs[i].as_py()
                if now is None or conv != key:
                    if now is not None:
                        done.append((key, *now.row()))
                    key, now = conv, Reading()
                now.add(segments[i].as_py(), starts[i].as_py(), ends[i].as_py())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind if n == 0 else None) for n, c in enumerate(zip(*done, strict=True))], names=names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], kind if n == 0 else None) for n, c in enumerate((key, *now.row()))], names=names)

    ordered = formatted.select("conv_id", "turn", "role", "segment", "loss_start", "loss_end").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "segment")
    return map_batches(ordered.select("conv_id", "segment", "loss_start", "loss_end"), run, schema)
