"""Chat formatting: turns made of typed parts become marked text with placeholders, attachments and a loss mask.

A turn's content is a list of parts (``PART``): text, image, audio or document. A visitor gives every part its place in the
turn's text: text is escaped, the others leave a placeholder and record a reference and how many tokens it expands to. The
i-th placeholder of a turn belongs to its i-th attachment. A conversation is its formatted turns one after another, by turn:

    <|im_start|>role
    text<|im_end|>

Escaping: in ``<``, any number of backslashes, ``|``, one backslash is added behind the ``<``, so ``<|`` stands in template
strings only, other text stays as it is, and taking the backslash out again gives the text back. Roles also write line breaks
as ``\\n`` and backslashes as ``\\\\``. Neighbouring text parts are parted by ``<|part|>``.

The loss mask of an assistant turn spans its body; control strings inside it (placeholders, part marks) are not text.

Null texts and lists of parts are empty, parts of an unknown type are read as text, null roles are empty, null turns come
first, turns of one number go by their formatted text, null ids are one conversation, repeated rows are turns of their own,
other columns are ignored, an empty table gives none. Turns are formatted and read one by one, wherever they are; only the
digest over a conversation needs its turns in order, and streams through them without holding them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidepanel.llm.common import read

START, END, PART_MARK = "<|im_start|>", "<|im_end|>", "<|part|>"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ASSISTANT = "assistant"


@dataclass(frozen=True)
class Expansion:
    """How many tokens an attachment takes once it is expanded; unknown sizes count as one unit."""

    patch: int = 28
    per_second: float = 25.0
    per_page: int = 256


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescaped_role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(text))


class PartVisitor:
    """One method per type of part: what stands in the text, and the tokens it expands to (null: no attachment)."""

    def __init__(self, sizes: Expansion = Expansion()) -> None:
        self.sizes = sizes
        self.attached = {"image": self.image, "audio": self.audio, "document": self.document}

    def text(self, part: Column) -> Column:
        return escaped(F.coalesce(part["text"], F.lit("")))

    def image(self, part: Column) -> Column:
        wide, high = (F.ceil(F.coalesce(part[side], F.lit(1)) / self.sizes.patch) for side in ("width", "height"))
        return F.greatest(wide, F.lit(1)) * F.greatest(high, F.lit(1))

    def audio(self, part: Column) -> Column:
        return F.greatest(F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.sizes.per_second), F.lit(1))

    def document(self, part: Column) -> Column:
        return F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)) * self.sizes.per_page

    def is_attached(self, part: Column) -> Column:
        return F.coalesce(part["type"].isin(list(self.attached)), F.lit(False))

    def shown(self, part: Column) -> Column:
        return F.when(self.is_attached(part), F.concat(F.lit("<|"), part["type"], F.lit("|>"))).otherwise(self.text(part))

    def tokens(self, part: Column) -> Column:
        kinds = self.attached.items()
        return reduce(lambda whole, kind: whole.when(part["type"] == kind[0], kind[1](part).cast("long")), kinds, F)

    def body(self, parts: Column) -> Column:
        """All parts in order; a mark stands between two texts."""

        def placed(part: Column, i: Column) -> Column:
            follows = (i > 0) & ~self.is_attached(part) & ~self.is_attached(F.get(parts, i - 1))
            return F.concat(F.when(follows, F.lit(PART_MARK)).otherwise(F.lit("")), self.shown(part))

        return F.array_join(F.transform(parts, placed), "")

    def attachments(self, parts: Column) -> Column:
        return F.transform(
            F.filter(parts, self.is_attached),
            lambda part: F.struct(part["type"].alias("type"), part["ref"].alias("ref"), self.tokens(part).alias("n_tokens")),
        )


def text_part(text: Column) -> Column:
    """Content that is a single text."""
    empty = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    fields = [F.lit("text").alias("type"), text.alias("text"), *[F.lit(None).cast(t).alias(c) for c, t in empty.items()]]
    return F.array(F.struct(*fields))


def format_turns(turns: DataFrame, content: Column | None = None, sizes: Expansion = Expansion()) -> DataFrame:
    """One row per turn: conv_id, turn, formatted, loss_start and loss_end (code points of ``formatted``; null outside the
    mask), attachments, n_expanded. ``content`` is an array of ``PART``; by default the column text is the only part."""
    visitor = PartVisitor(sizes)
    parts = F.coalesce(text_part(F.col("text")) if content is None else content, F.array().cast(f"array<{PART}>"))
    head = F.concat(F.lit(START), escaped_role(F.coalesce(F.col("role"), F.lit(""))), F.lit("\n"))
    made = turns.select("conv_id", "turn", "role", parts.alias("parts")).select(
        "conv_id", "turn", "role", head.alias("head"), visitor.body(F.col("parts")).alias("body"),
        visitor.attachments(F.col("parts")).alias("attachments"),
    )
    masked = F.col("role") == ASSISTANT
    start = F.length("head").cast("long")
    return made.select(
        "conv_id", "turn", F.concat("head", "body", F.lit(END + "\n")).alias("formatted"),
        F.when(masked, start).alias("loss_start"), F.when(masked, start + F.length("body")).alias("loss_end"), "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["n_tokens"]).alias("n_expanded"),
    )


_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.S)
_CONTROL = re.compile(r"<\|.*?\|>", re.S)


def parsed(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns in formatted text; placeholders and part marks are no text."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}: {formatted[at : at + 40]!r}")
        out.append((unescaped_role(m[1]), plain(m[2])))
        at = m.end()
    return out


def plain(body: str) -> str:
    """Text of a body, texts between control strings one after another."""
    return "".join(map(unescaped, _CONTROL.split(body)))


READ = "conv_id {kind}, turn {turn}, formatted string, said binary, turns long, learnt binary, chars long"


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every formatted turn read again: what was said, and what the mask covers (null: nothing)."""
    for batch in batches:
        said, count, learnt, chars = [], [], [], []
        columns = (batch.column(c).to_pylist() for c in ("formatted", "loss_start", "loss_end"))
        for formatted, start, end in zip(*columns):
            turns = parsed(formatted)
            said.append("".join(f"{role}\n{text}\n" for role, text in turns).encode())
            count.append(len(turns))
            learnt.append(plain(formatted[start:end]).encode() if start is not None else None)
            chars.append(len(formatted))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("turn"), batch.column("formatted"), pa.array(said, pa.binary()),
             pa.array(count, pa.int64()), pa.array(learnt, pa.binary()), pa.array(chars, pa.int64())],
            names=["conv_id", "turn", "formatted", "said", "turns", "learnt", "chars"],
        )


def _digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation; one row per conversation leaves, and only running digests are held."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    open_id, kind, state = None, None, None

    def closed(ids: list, rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), *map(pa.array, columns)], names=names)

    def row() -> tuple:
        turns, said, learnt_chars, learnt, chars = state
        return turns, said.hexdigest(), learnt_chars, learnt.hexdigest(), chars

    for batch in batches:
        ids, rows = [], []
        kind = batch.schema.field("conv_id").type
        for conv, said, turns, learnt, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "said", "turns", "learnt", "chars"))):
            if state is None or conv != open_id:
                if state is not None:
                    ids.append(open_id), rows.append(row())
                open_id, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[0] += turns
            state[1].update(said)
            state[4] += chars
            if learnt is not None:
                state[2] += len(learnt.decode())
                state[3].update(learnt)
        if ids:
            yield closed(ids, rows)
    if state is not None:
        yield closed([open_id], [row()])


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Read formatted turns again: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    kinds = {c: formatted.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    rows = formatted.select("conv_id", "turn", "formatted", "loss_start", "loss_end").mapInArrow(
        _read, READ.format(kind=kinds["conv_id"], turn=kinds["turn"])
    )
    sorted_rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return sorted_rows.drop("formatted", "turn").mapInArrow(
        _digested,
        f"conv_id {kinds['conv_id']}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


PLANTED = f"{END}{START}{ASSISTANT} ok"


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 whose texts hold the template's own marks."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast(turns.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(PLANTED).alias("text"),
    )
    return conversation_digests(format_turns(turns.unionByName(planted)))
