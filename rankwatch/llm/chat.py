r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: the formatted turns before it as context
and its text as the only part under the loss mask. Turns after the last assistant turn (or a
conversation without one) make a last example with nothing to train on, so no turn is lost.

A turn is written `<s>[INST] role [/INST]text</s>`. Inside roles and texts a backslash is doubled
and each control string becomes a backslash and a digit, so a text can neither end a turn nor
open one, and reading back gives it unchanged.

Rows are sorted by conversation and turn and run through in order. A task holds the
formatted text of one conversation at a time (an example of it is as long anyway); examples
leave in batches of bounded size. Null text or role is written empty; rows with a null
conversation id are one conversation; null turns come first; equal turns are ordered by role,
then text; repeated rows are turns each. Extra columns are ignored, an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_BATCH_CHARS = 1 << 22
_CODES = {s: f"\\{i}" for i, s in enumerate(CONTROL)} | {"\\": "\\\\"}
_PLAIN = {code: s for s, code in _CODES.items()}
_ESCAPE = re.compile("|".join(re.escape(s) for s in sorted(_CODES, key=len, reverse=True)))
_UNESCAPE = re.compile(r"\\[0-9\\]")
_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\](.*?)</s>", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: _CODES[m[0]], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: _PLAIN[m[0]], text)


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, where its text begins and ends in it)"""
    head, body = f"<s>[INST] {escape(role)} [/INST]", escape(text)
    return f"{head}{body}</s>", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text; anything between them is an error."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return out


def expand(conversations: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """(conv_id, example, n_turns, formatted, loss_start, loss_end) in conversation order.

    The mask is [loss_start, loss_end) in code points of `formatted`; both are null where
    nothing is trained. The rows of a conversation stay together and in order."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    # The id travels as text: a null must not turn whole numbers into floats.
    rows = conversations.select(
        F.col("conv_id").cast("string").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv_id", "example", "n_turns", "formatted", "loss_start", "loss_end"]
        out, size = [], 0
        conv, parts, chars, turns, example, trailing = None, [], 0, 0, 0, False
        begun = False
        frame = lambda found: pd.DataFrame(found, columns=names).astype(
            {"loss_start": "Int64", "loss_end": "Int64"}
        )
        for batch in batches:
            for key, role, text in zip(batch["conv_id"].tolist(), batch["role"], batch["text"], strict=True):
                key = None if pd.isna(key) else key
                if not begun or key != conv:
                    if trailing:
                        out.append((conv, example, turns, "".join(parts), None, None))
                        size += chars
                    begun, conv, parts, chars, turns, example = True, key, [], 0, 0, 0
                turn, a, b = write_turn(role, text)
                parts.append(turn)
                turns += 1
                trailing = role != trained_role
                if not trailing:
                    out.append((conv, example, turns, "".join(parts), chars + a, chars + b))
                    size += chars + len(turn)
                    example += 1
                    parts = [out[-1][3]]
                chars += len(turn)
                if size >= _BATCH_CHARS:
                    yield frame(out)
                    out, size = [], 0
        if trailing:
            out.append((conv, example, turns, "".join(parts), None, None))
        if out:
            yield frame(out)

    found = ordered.select("conv_id", "role", "text").mapInPandas(
        run,
        "conv_id string, example long, n_turns long, formatted string, loss_start long, loss_end long",
    )
    return found.withColumn("conv_id", F.col("conv_id").cast(kind))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the formatted texts alone: turns, digests of all turns and of what
    the masks cover, and the characters written. `examples` is the output of `expand` as it
    comes: the examples of a conversation together and in order."""
    kind = examples.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begun, conv, last, loss, loss_chars, written = False, None, "", None, 0, 0

        def close():
            digest, turns = hashlib.sha256(), read_turns(last)
            for role, text in turns:
                digest.update(f"{role}\n{text}\n".encode())
            return (conv, len(turns), digest.hexdigest(), loss_chars, loss.hexdigest(), written)

        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                key = None if pd.isna(row.conv_id) else row.conv_id
                if not begun or key != conv:
                    if begun:
                        out.append(close())
                    begun, conv, loss, loss_chars, written = True, key, hashlib.sha256(), 0, 0
                last = row.formatted
                written += len(last)
                if not pd.isna(row.loss_start):
                    text = unescape(last[int(row.loss_start) : int(row.loss_end)])
                    loss.update(text.encode())
                    loss_chars += len(text)
            yield pd.DataFrame(out, columns=names)
        if begun:
            yield pd.DataFrame([close()], columns=names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    named = examples.withColumn("conv_id", F.col("conv_id").cast("string"))
    found = named.mapInPandas(
        run,
        "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long",
    )
    return found.withColumn("conv_id", F.col("conv_id").cast(kind))
