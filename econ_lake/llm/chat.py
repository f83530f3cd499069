"""Operator 7, chat formatting by token-level assembly.

The role and the text of each turn are encoded on their own, and reserved ids, which no text can give, are spliced
in between:  TURN role TEXT text END.  The loss mask (the tokens of assistant texts) is the prefix sum of +1 where
such a text begins and -1 where it ends.  Control strings inside texts get a backslash after their first character,
one more than they have, so that no text holds one and the change can be undone.

A conversation is never gathered: its output is one row per turn, in order.  Reading back takes it from the ids
alone; digests go on from row to row over the sorted turns.

Defined results: a null text or role counts as empty; turns are ordered by turn (null first), then role, then text;
repeated rows are turns of their own; rows with a null conv_id form one conversation; an empty table gives no rows;
other columns are not read; texts are formatted whole, whatever their length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from econ_lake.llm.shared import pieces

#: Reserved ids follow the vocabulary in this order.
CONTROL = ("<|turn|>", "<|text|>", "<|end|>")
#: What else may mean something to a tokenizer or a model is escaped too.
FOREIGN = ("<|endoftext|>", "<|startoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]")
_REST = "|".join(sorted((re.escape(c[1:]) for c in CONTROL + FOREIGN), key=len, reverse=True))
_PLAIN = re.compile(rf"([<\[])(\\*)({_REST})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_REST})")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # special strings in texts are ordinary text
    t.no_padding()
    t.no_truncation()
    return t


def assemble(roles: list[str], texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, loss mask and row offsets of turns laid end to end."""
    t = tokenizer(path)
    turn, begin, end = (t.get_vocab_size() + k for k in range(3))
    known = sorted(set(roles))  # a few
    role_ids = {r: e.ids for r, e in zip(known, t.encode_batch(list(map(escape, known)), add_special_tokens=False),
                                         strict=True)}
    text_ids = [e.ids for e in t.encode_batch(list(map(escape, texts)), add_special_tokens=False)]
    ids: list[int] = []
    at, opens, closes = [0], [], []
    for role, x in zip(roles, text_ids, strict=True):
        ids += [turn, *role_ids[role], begin]
        if role == "assistant":
            opens.append(len(ids))
            closes.append(len(ids) + len(x))
        ids += x
        ids.append(end)
        at.append(len(ids))
    step = np.zeros(len(ids) + 1, np.int32)
    np.add.at(step, opens, 1)
    np.subtract.at(step, closes, 1)
    return np.array(ids, np.int32), np.cumsum(step[:-1]) > 0, np.array(at, np.int32)


def format_turns(conversations: DataFrame, path: str) -> DataFrame:
    """conv_id, turn, ids, loss_mask of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            roles = [r or "" for r in part.column("role").to_pylist()]
            texts = [x or "" for x in part.column("text").to_pylist()]
            ids, mask, at = assemble(roles, texts, path)
            yield pa.RecordBatch.from_arrays(
                [part.column("conv_id"), part.column("turn"), pa.ListArray.from_arrays(at, pa.array(ids)),
                 pa.ListArray.from_arrays(at, pa.array(mask))], ["conv_id", "turn", "ids", "loss_mask"])

    kinds = {c: conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    return conversations.select("conv_id", "turn", "role", "text").mapInArrow(
        run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, ids array<int>, loss_mask array<boolean>")


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column end to end, and the n+1 offsets of its rows."""
    at = column.offsets.to_numpy()
    return column.values.slice(at[0], at[-1] - at[0]).to_numpy(zero_copy_only=False), at - at[0]


def read_back(turns: DataFrame, path: str) -> DataFrame:
    """conv_id, turn, role, text, loss_text, formatted: taken from ids and loss_mask alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        size = t.get_vocab_size()
        for batch in batches:
            ids, at = _flat(batch.column("ids"))
            mask, _ = _flat(batch.column("loss_mask"))
            marks = np.flatnonzero(ids >= size)
            turns = marks.reshape(-1, 3) if len(marks) == 3 * batch.num_rows else None
            if turns is None or (ids[turns] != [size, size + 1, size + 2]).any() or (
                    turns[:, 0] != at[:-1]).any() or (turns[:, 2] + 1 != at[1:]).any():
                raise ValueError("not the ids of turns")
            cuts = turns.tolist()
            heads = [tuple(ids[a + 1:b].tolist()) for a, b, _ in cuts]
            known = {h: t.decode(list(h), skip_special_tokens=False) for h in set(heads)}
            role = [known[h] for h in heads]
            text = t.decode_batch([ids[b + 1:c].tolist() for _, b, c in cuts], skip_special_tokens=False)
            # what the mask covers of each row, whatever that is
            loss_at = np.concatenate([[0], np.cumsum(mask)])[at].tolist()
            masked = ids[mask].tolist()
            some = [k for k in range(len(cuts)) if loss_at[k + 1] > loss_at[k]]
            loss = [""] * len(cuts)
            for k, told in zip(some, t.decode_batch([masked[loss_at[k]:loss_at[k + 1]] for k in some],
                                                    skip_special_tokens=False), strict=True):
                loss[k] = told
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn")] + [pa.array(x, pa.string()) for x in (
                    list(map(unescape, role)), list(map(unescape, text)), list(map(unescape, loss)),
                    [CONTROL[0] + r + CONTROL[1] + x + CONTROL[2] for r, x in zip(role, text, strict=True)])],
                ["conv_id", "turn", "role", "text", "loss_text", "formatted"])

    kinds = {c: turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    return turns.mapInArrow(run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, text string, "
                                 "loss_text string, formatted string")


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation, from rows of ``read_back``: digests go on over its turns, whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []  # of the conversation at hand: id, turns, digest, loss characters, digest, characters
        for batch in batches:
            for conv, role, text, loss, formatted in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "role", "text", "loss_text", "formatted")), strict=True):
                if now is None or now[0] != conv:
                    if now:
                        out.append(now)
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                now[3] += len(loss)
                now[4].update(loss.encode())
                now[5] += len(formatted)
            yield rows(out)
            out = []
        yield rows([now] if now else [])

    def rows(done: list) -> pa.RecordBatch:
        values = [[x.hexdigest() if hasattr(x, "hexdigest") else x for x in row] for row in done]
        return pa.RecordBatch.from_arrays(
            [pa.array([v[k] for v in values], kind) for k, kind in enumerate(
                (arrow_id, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], names)

    from pyspark.sql.pandas.types import to_arrow_type

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = turns.schema["conv_id"].dataType
    arrow_id = to_arrow_type(kind)
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(
        run, f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long"))


def report(conversations: DataFrame, path: str) -> DataFrame:
    return digests(read_back(format_turns(conversations, path), path))
