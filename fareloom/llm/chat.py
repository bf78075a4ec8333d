"""Chat formatting by prefix-target expansion."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import shuffle_partitions

#: Control strings of the template; inside texts each is escaped with a backslash.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TURN]")
#: What stands before and after a text of the roles the template knows.
FRAMES = {
    "user": ("[INST] ", " [/INST]"),
    "assistant": (" ", " </s>"),
    "system": ("<<SYS>> ", " <</SYS>>"),
}
_ANY = "|".join(re.escape(control) for control in sorted(CONTROLS, key=len, reverse=True))
_ESCAPE = re.compile(rf"\\|(?={_ANY})")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
#: Control strings that stand for themselves: no backslash before them.
_MARK = re.compile(rf"(?<!\\)(?:{_ANY})")

EXAMPLES = "conv_id long, example int, target_turn int, n_turns int, text string, loss_start int, loss_end int"

#: Characters of examples that are sent to Spark at once.
BATCH_CHARS = 4_000_000


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] else "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn under the template, and where its escaped text starts and ends."""
    if role in FRAMES:
        opener, closer = FRAMES[role]
    else:
        opener, closer = f"[ROLE] {escape(role)} [/ROLE] ", " [/TURN]"
    body = escape(text)
    return opener + body + closer, len(opener), len(opener) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of the turns of a formatted text."""
    marks = [(m[0], m.start(), m.end()) for m in _MARK.finditer(formatted)]
    turns, at, i = [], marks[0][2], 1
    while i < len(marks):
        mark, start, end = marks[i]
        if mark == "[INST]":
            role, begin, stop = "user", end + 1, marks[i + 1]
        elif mark == "<<SYS>>":
            role, begin, stop = "system", end + 1, marks[i + 1]
        elif mark == "[ROLE]":
            role = unescape(formatted[end + 1 : marks[i + 1][1] - 1])
            i += 1
            begin, stop = marks[i][2] + 1, marks[i + 1]
        else:  # </s>: an assistant's text has no mark before it
            role, begin, stop = "assistant", at + 1, marks[i]
            i -= 1
        turns.append((role, unescape(formatted[begin : stop[1] - 1])))
        at, i = stop[2], i + 2
    return turns


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Examples of conversations whose turns arrive one after the other."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("example", pa.int32()), ("target_turn", pa.int32()), ("n_turns", pa.int32()),
         ("text", pa.string()), ("loss_start", pa.int32()), ("loss_end", pa.int32())]
    )
    rows: list[tuple] = []
    held = 0
    conv, open_, prefix, n, example = None, False, "", 0, 0
    answered = True

    def batch() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for part in batches:
        ids, roles, texts = (part.column(c).to_pylist() for c in ("conv_id", "role", "text"))
        for conv_id, role, text in zip(ids, roles, texts, strict=True):
            if not open_ or conv_id != conv:
                if open_ and not answered:
                    rows.append((conv, example, None, n, prefix, None, None))
                    held += len(prefix)
                conv, open_, prefix, n, example = conv_id, True, "<s>", 0, 0
            turn, start, end = render(role or "", text or "")
            if role == "assistant":
                rows.append((conv, example, n, n + 1, prefix + turn, len(prefix) + start, len(prefix) + end))
                held += len(prefix) + len(turn)
                example += 1
            answered = role == "assistant"
            prefix, n = prefix + turn, n + 1
            if held > BATCH_CHARS:
                yield batch()
                rows, held = [], 0
    if open_ and not answered:
        rows.append((conv, example, None, n, prefix, None, None))
    yield batch()


def format_examples(turns: DataFrame) -> DataFrame:
    """One example per assistant turn: all turns before it, then the reply.

    ``text`` is the formatted example and ``loss_start`` to ``loss_end`` (code
    points) the part of it that is trained on: the escaped text of the reply. A
    conversation that does not end with a reply gives one more example of all its
    turns with nothing to train on (NULL target and span), so that no turn is
    lost. Rows of a conversation are ordered by turn, then role and text, so ties
    and repeated rows are turns of their own. NULL texts and roles count as empty,
    NULL conv_id as a conversation of its own; other columns are ignored. The
    turns stream through a task in order; it holds one conversation's text, as its
    last example does too.
    """
    columns = [F.col("conv_id").cast("long"), "turn", "role", "text"]
    ordered = (
        turns.select(*columns)
        .repartition(shuffle_partitions(turns.sparkSession), "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return ordered.mapInArrow(_expand, EXAMPLES)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        digests, losses, sizes = [], [], []
        rows = (part.column(c).to_pylist() for c in ("text", "loss_start", "loss_end"))
        for text, start, end in zip(*rows, strict=True):
            sizes.append(len(text))
            losses.append("" if start is None else unescape(text[start:end]))
            turns = parse(text)
            content = "".join(f"{role}\n{said}\n" for role, said in turns)
            digests.append((len(turns), hashlib.sha256(content.encode("utf-8", "surrogatepass")).hexdigest()))
        yield pa.record_batch(
            {
                "conv_id": part.column("conv_id"),
                "example": part.column("example"),
                "n_turns": pa.array([d[0] for d in digests], pa.int64()),
                "turns_sha256": pa.array([d[1] for d in digests], pa.string()),
                "loss_text": pa.array(losses, pa.string()),
                "formatted_chars": pa.array(sizes, pa.int64()),
            }
        )


def read_back(examples: DataFrame) -> DataFrame:
    """Digest per conversation of what its formatted examples hold.

    The turns come from the last example, which holds them all; the trained text
    from the loss spans of all examples, in order. ``formatted_chars`` counts the
    code points of all examples.
    """
    read = examples.select("conv_id", "example", "text", "loss_start", "loss_end").mapInArrow(
        _read,
        "conv_id long, example int, n_turns long, turns_sha256 string, loss_text string, formatted_chars long",
    )
    loss = F.array_join(
        F.transform(
            F.sort_array(F.collect_list(F.struct("example", "loss_text"))), lambda x: x["loss_text"]
        ),
        "",
    )
    grouped = read.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max_by("turns_sha256", "example").alias("turns_sha256"),
        loss.alias("_loss"),
        F.sum("formatted_chars").alias("formatted_chars"),
    )
    return grouped.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
