"""Operator 6: chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and only its own text is trainable. Turns
after the last assistant turn (or a conversation without any) give one more example without a trainable part, so the output
holds every turn and can be read back.

Template: `<|start|>role<|sep|>text<|end|>` for each turn. Inside roles and texts the first character of every control string is
written as a backslash code, and a backslash is doubled, so no control string of the template (or of other usual templates)
can come from a text, and undoing it gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|start|>", "<|sep|>", "<|end|>"
#: The beginnings of control strings. Every one begins with < or [.
_CONTROL = re.compile(r"\\|<(?=\|)|<(?=/?s>)|<(?=</?SYS>>)|\[(?=/?INST\])|<(?=(?:bos|eos|pad|unk|start_of_turn|end_of_turn)>)")
_CODES = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_PLAIN = {"\\": "\\", "l": "<", "b": "["}
_TURN = re.compile(r"<\|start\|>(.*?)<\|sep\|>(.*?)<\|end\|>", re.S)
EXAMPLES = "conv_id long, example int, formatted string, loss_start int, loss_end int, last boolean"
_BATCH_CHARS = 1 << 20


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: _CODES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text, flags=re.S)


def format_turn(role: str, text: str) -> str:
    return f"{START}{escape(role)}{SEP}{escape(text)}{END}"


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation and turn. At any time one conversation's prefix is held."""
    out, weight = [], 0

    def pack() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(("conv_id", "example", "formatted", "loss_start", "loss_end", "last"), x)) for x in out], schema=_SCHEMA)

    current, prefix, count, waiting, open_turns = (), "", 0, None, False
    for batch in batches:
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if current != (conv,):
                if current:
                    if open_turns or waiting is None:
                        if waiting is not None:
                            out.append((*waiting, False))
                        waiting = (current[0], count, prefix, 0, 0)
                    out.append((*waiting, True))
                    weight += len(waiting[2])
                current, prefix, count, waiting, open_turns = (conv,), "", 0, None, False
            role, text = role or "", text or ""
            turn = format_turn(role, text)
            if role == "assistant":
                if waiting is not None:
                    out.append((*waiting, False))
                    weight += len(waiting[2])
                begin = len(prefix) + len(START) + len(escape(role)) + len(SEP)
                prefix += turn
                waiting, count, open_turns = (conv, count, prefix, begin, len(prefix) - len(END)), count + 1, False
            else:
                prefix, open_turns = prefix + turn, True
            if weight > _BATCH_CHARS:
                yield pack()
                out, weight = [], 0
    if current:
        if open_turns or waiting is None:
            if waiting is not None:
                out.append((*waiting, False))
            waiting = (current[0], count, prefix, 0, 0)
        out.append((*waiting, True))
    if out:
        yield pack()


_SCHEMA = pa.schema([("conv_id", pa.int64()), ("example", pa.int32()), ("formatted", pa.string()), ("loss_start", pa.int32()), ("loss_end", pa.int32()), ("last", pa.bool_())])
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parse examples (in order) back to turns and trained texts, and digest them by conversation."""
    loss, loss_chars, total = hashlib.sha256(), 0, 0
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            text = row["formatted"]
            total += len(text)
            trained = unescape(text[row["loss_start"] : row["loss_end"]])
            loss.update(trained.encode())
            loss_chars += len(trained)
            if row["last"]:
                turns, n = hashlib.sha256(), 0
                for m in _TURN.finditer(text):
                    turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                    n += 1
                done.append({"conv_id": row["conv_id"], "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(), "formatted_chars": total})
                loss, loss_chars, total = hashlib.sha256(), 0, 0
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_DIGEST)


def expand_examples(turns: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) -> one row for each example: formatted text and its trainable span.

    Turns are ordered by turn (null first), then role and text, so repeated rows keep a defined order. Null roles and texts are
    empty; rows with a null conv_id form one conversation. A conversation is formatted by one task (its prefix is held, the
    examples are streamed out); other columns are ignored; an empty table gives no examples. `last` marks the example that holds
    all turns.
    """
    slim = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return slim.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_expand, EXAMPLES)


def chat_digests(turns: DataFrame) -> DataFrame:
    """conversations -> per conversation the digests of what is read back from its formatted examples."""
    return expand_examples(turns).mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
