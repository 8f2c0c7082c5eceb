r"""Chat formatting: typed content parts, flattened by a visitor into one text per turn.

A message is a row (conversation, turn, role, parts); a part has a kind (text, image, audio or
document), a text, a reference, and measures (width and height, seconds, pages). The visitor
walks the parts in order: text is escaped and kept, every other part becomes a numbered
placeholder, and its reference and the number of tokens it expands to are recorded.

    <turn role>
    escaped text <image 0> more text
    </turn>

``\``, ``<`` and ``#`` in texts and roles (and line breaks in roles) are escaped with ``\``, so that no
text can end a turn or look like a placeholder, and reading back gives every text exactly. The loss
mask covers the text parts of assistant turns, without marks and placeholders.

Turns are formatted row by row; a conversation is its turns in order. Nothing gathers a conversation
in memory: reading back goes through sorted rows one by one.

Defined results: null role, text or parts are empty; parts of an unknown kind are kept as text; turns that
are null come first, ties are ordered by role and content; repeated rows are repeated turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

PART = (
    "struct<kind: string, text: string, reference: string, width: int, height: int, "
    "seconds: double, pages: int>"
)
ATTACHMENT = "struct<number: int, kind: string, reference: string, place: int, tokens: bigint>"
SPAN = "struct<start: int, stop: int>"
PATCH = 28  # pixels a side that one image token stands for
AUDIO_RATE = 25  # tokens a second
PAGE_TOKENS = 1024  # tokens a page of a document
_ESCAPED = re.compile(r"[\\<#]")
_ROLE_ESCAPED = re.compile(r"[\\<#>\n]")
_UNESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<turn ((?:[^\\>]|\\.)*)>\n((?:[^\\]|\\.)*?)\n</turn>\n", re.DOTALL)
_PLACEHOLDER = re.compile(r"<(image|audio|document) (\d+)>")


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" + m[0], text)


def escape_role(role: str) -> str:
    return _ROLE_ESCAPED.sub(lambda m: "\\n" if m[0] == "\n" else "\\" + m[0], role)


def unescape(text: str, line_breaks: bool = False) -> str:
    if line_breaks:
        return _UNESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)
    return _UNESCAPED.sub(lambda m: m[1], text)


class Flattener:
    """Visits the parts of one message, in order."""

    def __init__(self, role: str):
        self.pieces = [f"<turn {escape_role(role)}>\n"]
        self.size = len(self.pieces[0])
        self.learns = role == "assistant"
        self.attachments: list[dict] = []
        self.spans: list[dict] = []
        self.tokens = 0

    def _put(self, piece: str) -> None:
        self.pieces.append(piece)
        self.size += len(piece)

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['kind']}", self.visit_text)(part)

    def visit_text(self, part: dict) -> None:
        start = self.size
        self._put(escape(part["text"] or ""))
        if self.learns and self.size > start:
            self.spans.append({"start": start, "stop": self.size})

    def visit_image(self, part: dict) -> None:
        across, down = (max(1, ceil((part[side] or 0) / PATCH)) for side in ("width", "height"))
        self._attach(part, across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach(part, max(1, ceil((part["seconds"] or 0) * AUDIO_RATE)))

    def visit_document(self, part: dict) -> None:
        self._attach(part, max(1, part["pages"] or 0) * PAGE_TOKENS)

    def _attach(self, part: dict, tokens: int) -> None:
        number = len(self.attachments)
        self.attachments.append(
            {
                "number": number,
                "kind": part["kind"],
                "reference": part["reference"],
                "place": self.size,
                "tokens": tokens,
            }
        )
        self.tokens += tokens
        self._put(f"<{part['kind']} {number}>")

    def finish(self) -> str:
        self._put("\n</turn>\n")
        return "".join(self.pieces)


def format_turns(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, place, formatted, loss, attachments, attachment_tokens) per message.

    ``messages`` has conv_id, turn, role and parts; ``place`` orders turns of equal number.
    """
    rows = messages.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("parts"), F.array()).cast(f"array<{PART}>").alias("parts"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            formatted, loss, attached, tokens = [], [], [], []
            for role, parts in zip(batch.column("role"), batch.column("parts")):
                visitor = Flattener(role.as_py())
                for part in parts.as_py():
                    if part is not None:
                        visitor.visit(part)
                formatted.append(visitor.finish())
                loss.append(visitor.spans)
                attached.append(visitor.attachments)
                tokens.append(visitor.tokens)
            span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            attachment = pa.list_(
                pa.struct(
                    [("number", pa.int32()), ("kind", pa.string()), ("reference", pa.string()),
                     ("place", pa.int32()), ("tokens", pa.int64())]
                )
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"), batch.column("turn"), pa.array(formatted, pa.string()),
                    pa.array(loss, span), pa.array(attached, attachment), pa.array(tokens, pa.int64()),
                ],
                ["conv_id", "turn", "formatted", "loss", "attachments", "attachment_tokens"],
            )

    return rows.mapInArrow(
        run,
        f"conv_id bigint, turn bigint, formatted string, loss array<{SPAN}>, "
        f"attachments array<{ATTACHMENT}>, attachment_tokens bigint",
    )


def text_messages(conversations: DataFrame) -> DataFrame:
    """Messages of one text part each, from conv_id, turn, role and text."""
    part = F.struct(
        F.lit("text").alias("kind"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("reference"),
        F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("int").alias("pages"),
    )
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def read_turn(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns in a formatted text; placeholders stay as they are."""
    for found in _TURN.finditer(formatted):
        yield unescape(found[1], line_breaks=True), unescape(found[2])


class _Digest:
    """What is read back of one conversation, turn by turn."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, spans: list[dict]) -> None:
        self.chars += len(formatted)
        for role, text in read_turn(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        for span in spans:
            text = unescape(formatted[span["start"] : span["stop"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id,
            "n_turns": self.turns,
            "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


_DIGESTS = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation: what its formatted turns say when they are read in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []
        for batch in batches:
            columns = (batch.column(n) for n in ("conv_id", "formatted", "loss"))
            for conv_id, text, spans in zip(*columns):
                conv_id = conv_id.as_py()
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        done.append(current.row())
                    current = _Digest(conv_id)
                current.add(text.as_py(), spans.as_py())
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, _DIGESTS)
                done = []
        if current is not None:
            done.append(current.row())
        if done:
            yield pa.RecordBatch.from_pylist(done, _DIGESTS)

    ordered = (
        formatted.select("conv_id", "turn", "formatted", "loss")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "formatted")
    )
    return ordered.mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )
