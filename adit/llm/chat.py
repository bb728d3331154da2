"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor walks over them in
order; text is escaped, every other part becomes a placeholder that names its kind and number,
and is recorded with its reference and the tokens it expands to. Turns are marked as

    <turn ROLE>TEXT</turn>

and inside texts and roles a backslash stands before every backslash and every ``<`` or ``>``, so
no text can open or close a turn or a placeholder, and reading back gives the text exactly.

A conversation is a run of rows, one formatted segment for each turn with its place; it is never
held as a whole, so its length has no bound. Assistant texts, without their marks, are under the
loss mask.

Defined results: a null text is empty and a null role is an empty role; turns that repeat a number
are ordered by role, then text; repeated rows are turns of their own; conversations with a null id
form one conversation; an empty table gives an empty result; unknown kinds of parts are documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adit.llm.common import table, text_of

PART = "struct<kind:string,text:string,ref:string,tokens:long>"
LOSS_ROLE = "assistant"
DEFAULT_TOKENS = {"image": 256, "audio": 128, "document": 512}
_SPECIAL = re.compile(r"([\\<>])")
_ESCAPED = re.compile(r"\\([\\<>])")
_TURN = re.compile(r"<turn ((?:[^\\<>]|\\[\\<>])*)>((?:[^\\<>]|\\[\\<>]|<(?!/turn>)[a-z]+ \d+/>)*)</turn>\n")
_HOLDER = re.compile(r"<[a-z]+ \d+/>")


def escape(text: str) -> str:
    return _SPECIAL.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class Flattener:
    """Visits the parts of one turn; placeholders are numbered within the turn."""

    out: list[str]
    attachments: list[tuple[str, int, str, int]]
    expanded: int = 0

    def text(self, part: dict) -> None:
        self.out.append(escape(part["text"] or ""))

    def attachment(self, kind: str, part: dict) -> None:
        number = len(self.attachments)
        tokens = DEFAULT_TOKENS[kind] if part.get("tokens") is None else part["tokens"]
        self.attachments.append((kind, number, part.get("ref") or "", tokens))
        self.expanded += tokens
        self.out.append(f"<{kind} {number}/>")

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        if kind == "text":
            self.text(part)
        else:
            self.attachment(kind if kind in DEFAULT_TOKENS else "document", part)


def flatten(parts: list[dict] | None) -> Flattener:
    walk = Flattener([], [])
    for part in parts or []:
        if part is not None:
            walk.visit(part)
    return walk


_SEGMENT = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("position", pa.int64()),
        ("start", pa.int64()),
        ("segment", pa.string()),
        ("loss_start", pa.int64()),
        ("loss_end", pa.int64()),
        ("attachments", pa.list_(pa.struct([("kind", pa.string()), ("number", pa.int64()), ("ref", pa.string()), ("tokens", pa.int64())]))),
        ("expanded_tokens", pa.int64()),
    ]
)
SEGMENT = (
    "conv_id long, position long, start long, segment string, loss_start long, loss_end long, "
    "attachments array<struct<kind:string,number:long,ref:string,tokens:long>>, expanded_tokens long"
)


def text_parts(turns: DataFrame, text_col: str = "text") -> DataFrame:
    """Turns of plain text, as turns of one text part each."""
    part = F.struct(F.lit("text").alias("kind"), text_of(text_col).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("tokens"))
    return turns.withColumn("parts", F.array(part))


def in_order(turns: DataFrame, id_col: str, turn_col: str, role_col: str, parts_col: str) -> DataFrame:
    """The rows of each conversation in one partition, in order of turns."""
    rows = turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.col(parts_col).cast(f"array<{PART}>").alias("parts"))
    return rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "turn", "role", "parts")


def formatted(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts") -> DataFrame:
    """One segment per turn: ``conv_id, position, start, segment, loss_start, loss_end, attachments, expanded_tokens``.

    The segments of a conversation, joined in order, are its formatted text; ``start`` and the
    half-open loss range (null where no loss is due) are code points of that text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, position, start = ..., 0, 0
        for batch in batches:
            out = []
            for conv, role, parts in zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                if conv != current:
                    current, position, start = conv, 0, 0
                walk = flatten(parts)
                opening, body = f"<turn {escape(role)}>", "".join(walk.out)
                segment = f"{opening}{body}</turn>\n"
                loss = (start + len(opening), start + len(opening) + len(body)) if role == LOSS_ROLE else (None, None)
                attached = [{"kind": k, "number": n, "ref": r, "tokens": t} for k, n, r, t in walk.attachments]
                out.append((conv, position, start, segment, *loss, attached, walk.expanded))
                position, start = position + 1, start + len(segment)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), _SEGMENT, strict=True)], schema=_SEGMENT)

    return in_order(turns, id_col, turn_col, role_col, parts_col).mapInArrow(run, SEGMENT)


def parse_segment(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn; placeholders are no text."""
    found = _TURN.fullmatch(segment)
    if found is None:
        raise ValueError("not a formatted turn")
    return unescape(found[1]), unescape(_HOLDER.sub("", found[2]))


_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of what the formatted conversations say, read from their segments.

    ``segments`` as ``formatted`` gives them: a conversation in one partition, in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def row(s):
            return s["conv"], s["n"], s["turns"].hexdigest(), s["loss"], s["masked"].hexdigest(), s["chars"]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)

        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "position", "start", "segment", "loss_start", "loss_end")]
            for conv, position, start, segment, low, high in zip(*columns, strict=True):
                if position == 0:
                    if state is not None:
                        done.append(row(state))
                    state = {"conv": conv, "n": 0, "turns": hashlib.sha256(), "loss": 0, "masked": hashlib.sha256(), "chars": 0}
                role, text = parse_segment(segment)
                state["turns"].update(f"{role}\n{text}\n".encode())
                state["n"] += 1
                state["chars"] = start + len(segment)
                if low is not None:
                    masked = unescape(_HOLDER.sub("", segment[low - start : high - start]))
                    state["masked"].update(masked.encode())
                    state["loss"] += len(masked)
            if done:
                yield batch_of(done)
        if state is not None:
            yield batch_of([row(state)])

    return segments.mapInArrow(run, READ)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    return read_back(formatted(text_parts(turns.unionByName(planted))))


OP6_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length(role) + length(regexp_replace(role, '[^\\<>]', '', 'g'))
          + length(text) + length(regexp_replace(text, '[^\\<>]', '', 'g')) + 15 AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
