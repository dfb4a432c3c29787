r"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered whole::

    <|turn|>user<|text|>Hello<|end|><|turn|>assistant<|text|>Hi<|end|>

The three marks are tokens of their own, put after the vocabulary's. In roles and texts a backslash is written
``\\`` and ``<|`` as ``<\|``: no text can hold a mark, and reading is unambiguous. The whole is encoded once,
with the offsets of its tokens; a token is under the loss mask if its span meets the span of an assistant's
text, found by binary search in the sorted spans. Marks always split tokens, so a mask ends exactly where its text does.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED = "assistant"
_FORMATTED = "conv_id long, formatted string, token_ids array<int>, loss_mask array<boolean>"


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescaped(text: str) -> str:
    return "\\".join(part.replace("<\\|", "<|") for part in text.split("\\\\"))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The whole conversation, and the spans of the texts to learn, in code points."""
    parts: list[str] = []
    spans, at = [], 0
    for role, text in turns:
        head, body = f"{TURN}{escaped(role)}{TEXT}", escaped(text)
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, END)
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    turns = []
    for turn in formatted.split(END)[:-1]:
        role, text = turn.removeprefix(TURN).split(TEXT)
        turns.append((unescaped(role), unescaped(text)))
    return turns


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens (start, stop) meet one of the sorted, disjoint spans."""
    if not spans or not len(offsets):
        return np.zeros(len(offsets), bool)
    spans = np.array([s for s in spans if s[0] < s[1]] or [(0, 0)])
    # The first span that ends after the token's start must begin before the token's end.
    near = np.searchsorted(spans[:, 1], offsets[:, 0], "right")
    starts = np.append(spans[:, 0], np.iinfo(np.int64).max)
    return (starts[near] < offsets[:, 1]) & (offsets[:, 0] < offsets[:, 1])


@lru_cache(4)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import AddedToken, Tokenizer

    made = Tokenizer.from_file(path)
    made.add_special_tokens([AddedToken(mark, special=True, normalized=False) for mark in (TURN, TEXT, END)])
    return made


def _format_task(path: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            for start in range(0, len(batch), 64):
                part = batch.slice(start, 64)
                texts, tokens, masks = [], [], []
                for turns in part.column("turns").to_pylist():
                    formatted, spans = render([(t["role"] or "", t["text"] or "") for t in turns])
                    encoded = tokenizer.encode(formatted, add_special_tokens=False)
                    texts.append(formatted)
                    tokens.append(encoded.ids)
                    masks.append(loss_mask(np.array(encoded.offsets, np.int64).reshape(-1, 2), spans))
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), pa.array(texts), pa.array(tokens, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.bool_()))],
                    names=["conv_id", "formatted", "token_ids", "loss_mask"],
                )

    return task


def formatted(conversations: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``(conv_id, formatted, token_ids, loss_mask)`` for every conversation of ``(conv_id, turn, role, text)``.

    Turns stand in order of ``turn``, nulls first, then by role and text; repeated rows are repeated turns. A null or
    empty text is an empty turn, a null role an empty role. Rows without a conv_id are one conversation. Further
    columns are ignored. A conversation is one row of the result, so its turns meet in one task.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", "role", "text").alias("t"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return turns.mapInArrow(_format_task(tokenizer), _FORMATTED)


def _read_task(path: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            made = []
            for start in range(0, len(batch), 64):
                part = batch.slice(start, 64)
                for text, ids, mask in zip(*(part.column(c).to_pylist() for c in ("formatted", "token_ids", "loss_mask")), strict=True):
                    turns = parse(text)
                    learned = "".join(unescaped(tokenizer.decode(run, skip_special_tokens=False)) for run in _runs(ids, mask))
                    said = "".join(f"{role}\n{words}\n" for role, words in turns)
                    made.append((len(turns), _digest(said), len(learned), _digest(learned), len(text)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*made, strict=True) if made else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return task


def _runs(ids: list[int], mask: list[bool]) -> list[list[int]]:
    """The tokens under the mask, a list for each unbroken run."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.array(mask, np.int8), [0]])))
    return [ids[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def read_back(made: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """What formatted conversations say: their turns from the text, what is learned from tokens and mask."""
    return made.mapInArrow(
        _read_task(tokenizer), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
