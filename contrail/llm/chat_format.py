"""Chat formatting on the level of tokens, with a loss mask, and reading it back.

Every text is encoded by itself; the control marks of the template are
spliced between the texts as reserved ids beyond the vocabulary, so no text
can produce one.  The loss mask comes from prefix sums of the segment
lengths: assistant texts and the mark that ends them.  In the rendered string
the marks stand as ``CONTROL``; an occurrence of one inside a text is escaped
by a backslash after its first character, and every backslash is doubled,
which can be undone exactly.

Rows are dealt out by conversation and sorted, and a conversation streams
through its task in parts of ``PART`` tokens, so memory stays bounded for any
number of turns.

Defined results: a null text or role is empty.  Rows of one turn go by role,
then text; a null turn is first.  Rows with a null conversation id form one
conversation.  Repeated rows are repeated turns.  An empty table gives no
conversation.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[=]", "[/ROLE]")
BEGIN, END, USER, USER_END, SYSTEM, SYSTEM_END, ROLE, ROLE_IS, ROLE_END = range(len(CONTROL))
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-splitting pattern that belongs to the vocabulary file.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PART = 1 << 16
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_encoders: dict[str, tiktoken.Encoding] = {}


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def encoder(vocabulary: bytes) -> tiktoken.Encoding:
    """The tokenizer of a vocabulary file, made once per worker."""
    key = hashlib.sha256(vocabulary).hexdigest()
    if key not in _encoders:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
        _encoders[key] = tiktoken.Encoding(key, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def first_reserved(enc: tiktoken.Encoding) -> int:
    """Id of the first control mark; the ids below belong to texts."""
    return enc.max_token_value + 1


def segments(role: str, text: str) -> list[tuple[int | str, bool]]:
    """Marks (numbers) and escaped texts of a turn, each with its place in the loss."""
    body = escape(text)
    if role == "assistant":
        return [(body, True), (END, True)]
    if role == "user":
        return [(USER, False), (body, False), (USER_END, False)]
    if role == "system":
        return [(SYSTEM, False), (body, False), (SYSTEM_END, False)]
    return [(ROLE, False), (escape(role), False), (ROLE_IS, False), (body, False), (ROLE_END, False)]


def _assembled(ids: list[np.ndarray], loss: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([len(x) for x in ids])
    starts = np.concatenate(([0], ends[:-1]))
    step = np.zeros(int(ends[-1]) + 1, dtype=np.int64)
    flag = np.array(loss)
    np.add.at(step, starts[flag], 1)
    np.add.at(step, ends[flag], -1)
    return np.concatenate(ids).astype(np.int32), np.cumsum(step[:-1]).astype(np.int8)


def _format_partition(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary.value)
        base = first_reserved(enc)
        conv, part, ids, loss, size, begun = None, 0, [], [], 0, False

        def out() -> pa.RecordBatch:
            tokens, mask = _assembled(ids, loss)
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x))
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([part], pa.int32()), one(tokens), one(mask)], ["conv_id", "part", "ids", "mask"])

        for batch in batches:
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text"))):
                if begun and (c != conv or size >= PART):
                    yield out()
                    part, ids, loss, size = (part + 1 if c == conv else 0), [], [], 0
                if not begun or c != conv:
                    conv, begun = c, True
                    ids.append(np.array([base + BEGIN])), loss.append(False)
                for what, masked in segments(role or "", text or ""):
                    got = np.array([base + what] if isinstance(what, int) else enc.encode_ordinary(what), dtype=np.int64)
                    ids.append(got), loss.append(masked)
                    size += len(got)
        if begun:
            yield out()

    return run


def format_conversations(turns: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``conv_id, part, ids, mask``: the parts of a conversation stand together and in order in a partition."""
    with open(tokenizer, "rb") as f:  # under 1 MB, a fixed file
        vocabulary = turns.sparkSession.sparkContext.broadcast(f.read())
    rows = turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(_format_partition(vocabulary), "conv_id long, part int, ids array<int>, mask array<byte>")


class _Reader:
    """Rebuilds turns from tokens, a conversation at a time."""

    def __init__(self, enc: tiktoken.Encoding):
        self.enc, self.base = enc, first_reserved(enc)
        self.digest, self.loss = hashlib.sha256(), hashlib.sha256()
        self.turns = self.loss_chars = self.chars = 0
        self.role, self.held, self.held_loss = None, [], []

    def _text(self, ids: list[int]) -> str:
        return self.enc.decode_bytes(ids).decode("utf-8")

    def _mark(self, mark: int) -> None:
        """A control mark ends the text before it."""
        raw = self._text(self.held)
        self.chars += len(raw) + len(CONTROL[mark])
        text = unescape(raw)
        under = unescape(self._text(self.held_loss))
        self.loss.update(under.encode())
        self.loss_chars += len(under)
        self.held, self.held_loss = [], []
        if mark == ROLE_IS:
            self.role = text
        elif mark in (END, USER_END, SYSTEM_END, ROLE_END):
            role = {END: "assistant", USER_END: "user", SYSTEM_END: "system"}.get(mark, self.role)
            self.digest.update(f"{role}\n{text}\n".encode())
            self.turns += 1

    def feed(self, ids: np.ndarray, mask: np.ndarray) -> None:
        at = 0
        for end in np.append(np.flatnonzero(ids >= self.base), len(ids)).tolist():
            self.held += ids[at:end].tolist()
            self.held_loss += ids[at:end][mask[at:end] == 1].tolist()
            if end < len(ids):
                self._mark(int(ids[end]) - self.base)
            at = end + 1

    def row(self, conv) -> tuple:
        return conv, self.turns, self.digest.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Digests of what the formatted parts hold: turns, text under the mask, length of the rendered string."""
    with open(tokenizer, "rb") as f:
        vocabulary = formatted.sparkSession.sparkContext.broadcast(f.read())
    names = [c.split()[0] for c in _READ.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary.value)
        conv, reader, rows = None, None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names)

        for batch in batches:
            ids, mask = batch.column("ids"), batch.column("mask")
            for i, (c, part) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("part").to_pylist())):
                if part == 0:
                    if reader is not None:
                        rows.append(reader.row(conv))
                    conv, reader = c, _Reader(enc)
                reader.feed(ids[i].values.to_numpy(), mask[i].values.to_numpy())
            if rows:
                yield out()
                rows = []
        if reader is not None:
            rows.append(reader.row(conv))
            yield out()

    return formatted.mapInArrow(run, _READ)


def rendered(ids: np.ndarray, tokenizer: str = TOKENIZER) -> str:
    """The string of a token sequence, control marks included."""
    with open(tokenizer, "rb") as f:
        enc = encoder(f.read())
    base, out, at = first_reserved(enc), [], 0
    ids = np.asarray(ids)
    for end in np.append(np.flatnonzero(ids >= base), len(ids)).tolist():
        out.append(enc.decode_bytes(ids[at:end].tolist()).decode("utf-8"))
        if end < len(ids):
            out.append(CONTROL[int(ids[end]) - base])
        at = end + 1
    return "".join(out)
