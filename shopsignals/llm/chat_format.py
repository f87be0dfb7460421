"""Chat formatting: conversations as token ids with a loss mask, readable back.

1. *Segments*: every turn's text (and the name of a role without marks of its
   own) is escaped and encoded separately, in the scan and before anything is
   grouped, so a hot conversation is encoded by many tasks.  Texts over
   ``PIECE`` characters are encoded in several pieces of that size.
2. *Escaping*: where a text holds a control string of the template, with any
   number of ``\\`` after its first character, one more ``\\`` is put there.  An
   escaped text holds no control string, and taking one ``\\`` out of each such
   place gives the text back.
3. *Assembly*: turns are dealt by ranges of (conversation, turn), so a long
   conversation spreads over tasks too.  In each task whole turns are joined to
   chunks; a chunk takes turns until it holds ``CHUNK_TOKENS`` ids.  Reserved ids
   of the control strings and the segments' ids are put at places given by a
   running sum of lengths, and the loss mask is the running sum of +1 at the
   first id of an assistant text and -1 behind its last.  This table
   (``formatted``) is the output: one row per chunk; ``part`` and ``chunk`` give
   the order, ``whole`` says that a chunk is all of its conversation (not known
   of the first and last conversation of a task's range).
4. *Reading back* (``read_back``): chunks are split at reserved ids, decoded
   and unescaped.  Whole chunks are digested where they are read; the texts of
   others go on, sorted by conversation and chunk, to tasks that digest them as
   a stream.  SHA-256 is sequential, so one task passes over all texts of a
   conversation, but it holds one chunk at a time.

Template: ``<<SYS>>`` text ``<</SYS>>`` and ``[INST]`` text ``[/INST]`` are
system and user turns; an assistant turn is its text and ``</s>``; any other
role is ``[ROLE]`` name ``[/ROLE]`` text ``</s>``.  Only the assistant's text is
under the loss mask (the id of its ``</s>`` too with ``train_on_close``; it is no
text and reading back leaves it out).

Defined results: null and empty texts are empty segments; a null role is the
empty name; turns are ordered by turn (null first), those of one number by a hash of role
and text, so repeated rows are turns that follow each other; rows with a null conversation
id are one conversation with a null id; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignals.llm.common import arrow_rows, materialize, per_process, small_batches

#: characters encoded at once
PIECE = 1 << 16
#: a chunk takes turns until it holds so many ids
CHUNK_TOKENS = 1 << 15
ESCAPE = "\\"
CLOSE, ROLE, ROLE_END = "</s>", "[ROLE]", "[/ROLE]"


@dataclass(frozen=True)
class Template:
    """Control strings; ``marks`` are (role, opening, closing) of roles with marks of their own, "" for none."""

    marks: tuple[tuple[str, str, str], ...] = (("system", "<<SYS>>", "<</SYS>>"), ("user", "[INST]", "[/INST]"), ("assistant", "", CLOSE))
    loss_role: str = "assistant"

    def __post_init__(self):
        c = self.controls
        overlapping = any(a != b and (a in b or any(a.endswith(b[:i]) for i in range(1, len(b)))) for a in c for b in c)
        overlapping |= any(a.endswith(a[:i]) for a in c for i in range(1, len(a)))
        if overlapping or any(ESCAPE in a or len(a) < 2 for a in c):
            raise ValueError("control strings must not overlap, contain each other or hold the escape character")
        if sum(not opening for _, opening, _ in self.marks) > 1 or any(closing != CLOSE for _, opening, closing in self.marks if not opening):
            raise ValueError("one role may have no opening string; its turns end with " + CLOSE)

    @cached_property
    def controls(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([CLOSE, ROLE, ROLE_END, *(s for _, a, b in self.marks for s in (a, b) if s)]))

    @cached_property
    def _in_text(self) -> re.Pattern:
        return re.compile("|".join(f"(?<={re.escape(c[0])})(?=\\\\*{re.escape(c[1:])})" for c in self.controls))

    @cached_property
    def _escaped(self) -> re.Pattern:
        return re.compile("|".join(f"(?<={re.escape(c[0])})\\\\(?=\\\\*{re.escape(c[1:])})" for c in self.controls))

    def escape(self, text: str) -> str:
        return self._in_text.sub(lambda _: ESCAPE, text) if any(c[0] in text for c in self.controls) else text

    def unescape(self, text: str) -> str:
        return self._escaped.sub("", text) if ESCAPE in text else text

    def turn(self, role: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """Control strings before and behind a turn's text; None stands for the encoded role name."""
        for name, opening, closing in self.marks:
            if role == name:
                return ((opening,) if opening else ()), (closing,)
        return (ROLE, None, ROLE_END), (CLOSE,)


class Codec:
    """Ids of a byte-level vocabulary, and reserved ids above it for the control strings."""

    def __init__(self, path: str, template: Template):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.template = template
        self.encoding = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.first = max(ranks.values()) + 1  #: the lowest reserved id
        self.bytes = [b""] * self.first
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.reserved = {c: self.first + i for i, c in enumerate(template.controls)}

    def encode(self, text: str) -> list[int]:
        """Ids of an escaped text; none of them is reserved."""
        if len(text) <= PIECE:
            return self.encoding.encode_ordinary(text)
        return [i for k in range(0, len(text), PIECE) for i in self.encoding.encode_ordinary(text[k : k + PIECE])]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode()

    def text(self, ids: list[int]) -> str:
        """The formatted text of ids."""
        controls = self.template.controls
        return b"".join(self.bytes[i] if i < self.first else controls[i - self.first].encode() for i in ids).decode()


def vocabulary_path(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _codec(path: str, template: Template) -> Codec:
    return per_process(("chat codec", path, template), lambda: Codec(path, template))


# ---------------------------------------------------------------- formatting

TURN = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("tie", pa.int64()), ("role", pa.string()), ("named", pa.list_(pa.int32())), ("ids", pa.list_(pa.int32()))])
TURN_DDL = "conv_id long, turn long, tie long, role string, named array<int>, ids array<int>"
CHUNK = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("conv_id", pa.int64()), ("whole", pa.bool_()), ("ids", pa.list_(pa.int32())), ("mask", pa.list_(pa.int8()))])
CHUNK_DDL = "part int, chunk long, conv_id long, whole boolean, ids array<int>, mask array<tinyint>"


def encoded_turns(rows: DataFrame, path: str, template: Template) -> DataFrame:
    """``conv_id, turn, tie, role, text`` as separately encoded segments."""

    def run(batches):
        codec, own = _codec(path, template), {name for name, _, _ in template.marks}
        for b in batches:
            roles = [r or "" for r in b.column(3).to_pylist()]
            ids = [codec.encode(template.escape(t)) if t else [] for t in b.column(4).to_pylist()]
            named = [[] if r in own else codec.encode(template.escape(r)) for r in roles]
            yield arrow_rows(TURN, {"conv_id": b.column(0), "turn": b.column(1), "tie": b.column(2), "role": roles, "named": named, "ids": ids})

    return rows.mapInArrow(run, TURN_DDL)


def _slices(column: pa.Array) -> list[np.ndarray]:
    """The lists of an Arrow list column as views of its values."""
    values, at = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:z] for a, z in zip(at[:-1], at[1:])]


def assemble(codec: Codec, turns: list[tuple[str, np.ndarray, np.ndarray]], train_on_close: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(ids, mask) of turns (role, ids of its name, ids of its text) spliced with reserved ids."""
    lengths, controls, segments, spans = [], [], [], []
    for role, named, ids in turns:
        before, behind = codec.template.turn(role)
        for c in (*before, ids, *behind):
            if isinstance(c, str):
                controls.append((len(lengths), codec.reserved[c]))
                lengths.append(1)
                continue
            part = named if c is None else c
            if c is not None and role == codec.template.loss_role:
                spans.append((len(lengths), len(lengths) + 1 + train_on_close))
            segments.append((len(lengths), part))
            lengths.append(len(part))
    at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    out, step = np.zeros(at[-1], np.int32), np.zeros(at[-1] + 1, np.int64)
    where, what = zip(*controls)
    out[at[list(where)]] = what
    for k, part in segments:
        out[at[k] : at[k + 1]] = part
    for first, behind in spans:
        step[at[first]] += 1
        step[at[behind]] -= 1
    return out, np.cumsum(step[:-1]).astype(np.int8)


def formatted(conversations: DataFrame, path: str | None = None, template: Template = Template(), train_on_close: bool = False, chunk_tokens: int = CHUNK_TOKENS, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``part, chunk, conv_id, whole, ids, mask``: conversations in order, in chunks of whole turns, written once."""
    path = path or vocabulary_path()
    small_batches(conversations.sparkSession, 512)
    column = lambda c: F.col(f"`{c}`")
    rows = conversations.select(
        column(id_col).cast("long").alias("conv_id"), column(turn_col).cast("long").alias("turn"), F.xxhash64(column(role_col), column(text_col)).alias("tie"),
        column(role_col).alias("role"), column(text_col).alias("text"),
    )
    # written first: dealing by ranges reads its input twice, and texts should be encoded once
    turns = materialize(encoded_turns(rows, path, template))
    # the row number only spreads equal rows; either order of theirs is right
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "tie", "row")]
    dealt = turns.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        codec, part, chunk = _codec(path, template), TaskContext.get().partitionId(), 0
        held, size, conv, earlier = [], 0, None, True

        def flush(whole):
            ids, mask = assemble(codec, held, train_on_close)
            return arrow_rows(CHUNK, {"part": [part], "chunk": [chunk], "conv_id": [conv], "whole": [whole], "ids": [ids], "mask": [mask]})

        for b in batches:
            conv_ids, roles, named, texts = b.column(0).to_pylist(), b.column(1).to_pylist(), _slices(b.column(2)), _slices(b.column(3))
            for conv_id, role, name, ids in zip(conv_ids, roles, named, texts):
                if held and (conv_id != conv or size >= chunk_tokens):
                    yield flush(not earlier and conv_id != conv)
                    # of the task's first conversation, and of one already cut, a chunk is not known to be all
                    earlier = conv_id == conv
                    chunk, held, size = chunk + 1, [], 0
                conv = conv_id
                held.append((role, name, ids))
                size += len(ids)
        if held:
            yield flush(False)

    return materialize(dealt.select("conv_id", "role", "named", "ids").mapInArrow(run, CHUNK_DDL))


# ---------------------------------------------------------------- reading back


def parsed(codec: Codec, ids: np.ndarray, mask: np.ndarray):
    """Turns of a chunk: (role, text, text under the mask, characters of the turn as formatted)."""
    template, names = codec.template, codec.template.controls
    opening = {a: (role, z) for role, a, z in template.marks if a}
    plain = next((role for role, a, _ in template.marks if not a), "")
    marks = np.flatnonzero(ids >= codec.first)
    at = k = 0

    def control(k):
        return names[ids[marks[k]] - codec.first]

    while at < len(ids):
        role, chars = plain, 0
        if marks[k] == at and control(k) != CLOSE:
            name = control(k)
            chars, at, k = len(name), at + 1, k + 1
            if name == ROLE:
                role = codec.decode(ids[at : marks[k]].tolist())
                chars += len(role) + len(ROLE_END)
                role, at, k = template.unescape(role), marks[k] + 1, k + 1
            else:
                role = opening[name][0]
        end = marks[k]
        escaped = codec.decode(ids[at:end].tolist())
        text, chosen = template.unescape(escaped), mask[at:end] > 0
        under = text if chosen.all() else template.unescape(codec.decode(ids[at:end][chosen].tolist()))
        yield role, text, under if len(chosen) else "", chars + len(escaped) + len(control(k))
        at, k = end + 1, k + 1


BACK = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
BACK_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
TEXTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("chunk", pa.int64()), ("n_turns", pa.int64()), ("turns", pa.binary()), ("loss", pa.binary()), ("loss_chars", pa.int64()), ("formatted_chars", pa.int64())])
TEXTS_DDL = "conv_id long, part int, chunk long, n_turns long, turns binary, loss binary, loss_chars long, formatted_chars long"


def _chunk_texts(codec: Codec, ids: np.ndarray, mask: np.ndarray) -> tuple[int, bytes, bytes, int, int]:
    turns = list(parsed(codec, ids, mask))
    loss = "".join(t[2] for t in turns)
    return len(turns), "".join(f"{role}\n{text}\n" for role, text, _, _ in turns).encode(), loss.encode(), len(loss), sum(t[3] for t in turns)


def read_back(table: DataFrame, path: str | None = None, template: Template = Template()) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` from a formatted table."""
    path = path or vocabulary_path()

    def whole(batches):
        codec = _codec(path, template)
        for b in batches:
            out = {f.name: [] for f in BACK}
            out["conv_id"] = b.column(0)
            for ids, mask in zip(_slices(b.column(1)), _slices(b.column(2))):
                n, turns, loss, loss_chars, chars = _chunk_texts(codec, ids, mask)
                for name, value in zip(BACK.names[1:], (n, hashlib.sha256(turns).hexdigest(), loss_chars, hashlib.sha256(loss).hexdigest(), chars)):
                    out[name].append(value)
            yield arrow_rows(BACK, out)

    def texts(batches):
        codec = _codec(path, template)
        for b in batches:
            for i, (ids, mask) in enumerate(zip(_slices(b.column(3)), _slices(b.column(4)))):
                n, turns, loss, loss_chars, chars = _chunk_texts(codec, ids, mask)
                yield arrow_rows(TEXTS, {"conv_id": b.column(0).slice(i, 1), "part": b.column(1).slice(i, 1), "chunk": b.column(2).slice(i, 1), "n_turns": [n], "turns": [turns], "loss": [loss], "loss_chars": [loss_chars], "formatted_chars": [chars]})

    def stream(batches):
        conv, state = None, None

        def row():
            n, turns, loss, loss_chars, chars = state
            return arrow_rows(BACK, {"conv_id": [conv], "n_turns": [n], "turns_sha256": [turns.hexdigest()], "loss_chars": [loss_chars], "loss_sha256": [loss.hexdigest()], "formatted_chars": [chars]})

        for b in batches:
            for conv_id, n, turns, loss, loss_chars, chars in zip(*[c.to_pylist() for c in b.columns]):
                if state is None or conv_id != conv:
                    if state is not None:
                        yield row()
                    conv, state = conv_id, [0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                state[0] += n
                state[1].update(turns)
                state[2].update(loss)
                state[3] += loss_chars
                state[4] += chars
        if state is not None:
            yield row()

    done = table.where("whole").select("conv_id", "ids", "mask").mapInArrow(whole, BACK_DDL)
    rest = table.where("NOT whole").select("conv_id", "part", "chunk", "ids", "mask").mapInArrow(texts, TEXTS_DDL)
    rest = rest.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk").select("conv_id", "n_turns", "turns", "loss", "loss_chars", "formatted_chars")
    return done.unionByName(rest.mapInArrow(stream, BACK_DDL))


#: a conversation whose texts are made of control strings
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def chat_formatting(conversations: DataFrame) -> DataFrame:
    """All conversations and number -1, a user's and an assistant's turn of control strings, formatted and read back."""
    own = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = own.sparkSession.range(0, 2, 1, 1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    return read_back(formatted(own.unionByName(extra)))
