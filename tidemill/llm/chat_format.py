"""Operator 11: chat formatting by columnar byte assembly.

Every turn is three segments: its role's header, its text, its role's footer. For a
slice of turns, the lengths of the segments give offsets by cumulative sums; headers,
texts and footers are then copied by scatter indices into one buffer, which Arrow
takes as it is. No string of a single turn is built.

Turns are range-partitioned by conversation and turn, so that a conversation with very
many turns is spread over tasks; each task writes its conversations in pieces of about
``PIECE_BYTES``. Pieces of a conversation, in order, make up its formatted text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tidemill.llm.common import ragged, table
from tidemill.operators.scale import literal_rows

#: Text bytes of a slice that is assembled at once, and about the longest piece of more than one turn.
PIECE_BYTES = 1 << 20
#: Headers and footers by role; any other role is named in its header.
MARKS = {"system": ("<s><<SYS>>\n", "\n<</SYS>></s>"), "user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", " </s>")}
OTHER = ("<s>[ROLE] {} [/ROLE] ", " </s>")
#: The control strings, parted after the first character, and backslashes between: texts get one more there.
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\]|<SYS>>|</SYS>>)"
#: Roles whose texts are learned.
LEARNED = ("assistant",)

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_PIECES = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
    ("loss", _SPANS), ("whole", pa.bool_()),
])
_RESULT = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])
_HALF_READ = pa.schema([*_RESULT, ("part", pa.int32()), ("piece", pa.int64()), ("formatted", pa.string()), ("loss", _SPANS)])
_READ = re.compile("|".join([*(re.escape(a) + "(.*?)" + re.escape(b) for a, b in MARKS.values()), re.escape("<s>[ROLE] ") + "(.*?)" + re.escape(" [/ROLE] ") + "(.*?)" + re.escape(" </s>")]), re.S)
_ESCAPED = re.compile(CONTROL.replace(r"(\\*)", r"\\(\\*)"))


def escape(texts: pa.Array) -> pa.Array:
    """One backslash more inside every control string, so that none is left and all come back."""
    return pc.replace_substring_regex(texts, CONTROL, r"\1\\\2\3")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each string ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All turns one after the other: the bytes, where each turn ends in them, and the
    characters of each turn's header, text and footer."""
    coded = pc.fill_null(roles, "").dictionary_encode()
    known = pa.array([MARKS.get(r) or tuple(m.format(r) for m in OTHER) for r in escape(coded.dictionary).to_pylist()], pa.list_(pa.string())).flatten()
    marks, mark_ends = _bytes(known)
    mark_sizes, mark_chars = np.diff(mark_ends, prepend=0), np.asarray(pc.utf8_length(known)).astype(np.int64)
    inner = escape(pc.fill_null(texts, ""))
    body, body_ends = _bytes(inner)
    role = np.asarray(coded.indices).astype(np.int64)

    source = np.stack([2 * role, np.zeros_like(role), 2 * role + 1], 1)  # header, text, footer of each turn
    sizes = mark_sizes[source]
    sizes[:, 1] = np.diff(body_ends, prepend=0)
    ends = np.cumsum(sizes.ravel()).reshape(sizes.shape)
    starts = ends - sizes
    out = np.empty(int(ends[-1, 2]) if len(ends) else 0, np.uint8)
    out[ragged(starts[:, 1], sizes[:, 1])] = body
    for i in (0, 2):
        out[ragged(starts[:, i], sizes[:, i])] = marks[ragged((mark_ends - mark_sizes)[source[:, i]], sizes[:, i])]
    chars = mark_chars[source]
    chars[:, 1] = np.asarray(pc.utf8_length(inner))
    return out, ends[:, 2], chars


def _pieces(batch: pa.RecordBatch, cuts: np.ndarray) -> list[pa.Array]:
    """n_turns, formatted and loss of the pieces that start at ``cuts`` in a slice of turns."""
    out, ends, chars = assemble(batch["role"], batch["text"])
    last = np.r_[cuts[1:], len(batch)] - 1
    offsets = pa.array(np.r_[0, ends[last]].astype(np.int32))
    formatted = pa.StringArray.from_buffers(len(cuts), offsets.buffers()[1], pa.py_buffer(out))
    turn_ends = np.cumsum(chars.sum(1))
    piece = np.repeat(np.arange(len(cuts)), last - cuts + 1)
    base = np.r_[0, turn_ends[last[:-1]]][piece]
    start = turn_ends - chars[:, 1] - chars[:, 2] - base
    learned = np.flatnonzero(np.asarray(pc.is_in(pc.fill_null(batch["role"], ""), pa.array(LEARNED))))
    spans = pa.StructArray.from_arrays([pa.array(start[learned]), pa.array((start + chars[:, 1])[learned])], ["start", "stop"])
    counts = np.bincount(piece[learned], minlength=len(cuts))
    loss = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), spans)
    return [pa.array(last - cuts + 1), formatted, loss]


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's turns, in order, as pieces. A piece is the whole conversation if another one is seen on
    either side of it; of the last conversation of a slice, that shows when the next slice comes."""
    from pyspark import TaskContext

    part, number, previous, held = TaskContext.get().partitionId(), 0, (), None

    def finished(rows: list[pa.Array], conv: list, whole: list[bool]) -> pa.RecordBatch:
        nonlocal number
        at = pa.array(np.arange(number, number + len(conv)))
        number += len(conv)
        return pa.RecordBatch.from_arrays(
            [pa.array(conv, pa.int64()), pa.array(np.full(len(conv), part, np.int32)), at, *rows, pa.array(whole)],
            schema=_PIECES,
        )

    for batch in _slices(batches):
        ids = batch["conv_id"].to_pylist()
        cuts = np.flatnonzero([i == 0 or ids[i] != ids[i - 1] for i in range(len(ids))])
        conv = [ids[i] for i in cuts]
        rows = _pieces(batch, cuts)
        if held:  # the last piece of the slice before
            yield finished(held[0], [held[1]], [held[2] and held[1] != conv[0]])
        alone = [i > 0 or (previous != () and previous != conv[0]) for i in range(len(conv))]
        yield finished([r.slice(0, len(conv) - 1) for r in rows], conv[:-1], alone[:-1])
        held, previous = ([r.slice(len(conv) - 1) for r in rows], conv[-1], alone[-1]), conv[-1]
    if held:
        yield finished(held[0], [held[1]], [False])
    pa.default_memory_pool().release_unused()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of about ``PIECE_BYTES`` of text, at least one turn, none empty."""
    for batch in batches:
        sizes = np.array(pc.fill_null(pc.binary_length(batch["text"]), 0), np.int64)
        group = (np.cumsum(sizes) - sizes) // PIECE_BYTES
        cuts = np.flatnonzero(np.r_[True, np.diff(group) > 0, True]) if len(sizes) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(a, b - a)


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The formatted conversations, in pieces: conv_id, part and piece (their order), n_turns, formatted,
    loss (where the texts to learn lie in ``formatted``, in characters) and whole.

    Turns go by number, then role and text, nulls first; rows that repeat are turns of their own.
    Null texts and roles are empty. Rows without a conversation id are one conversation
    with a null id. Pieces never part a turn. ``whole`` is true where a piece is
    known to be all of its conversation; the first and last of a partition are not.
    """
    plain = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    dealt = plain.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(_format, from_arrow_schema(_PIECES))


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a formatted text."""
    at = 0
    for m in _READ.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        if m.lastindex > len(MARKS):
            yield unescape(m[m.lastindex - 1]), unescape(m[m.lastindex])
        else:
            yield list(MARKS)[m.lastindex - 1], unescape(m[m.lastindex])
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")


class Reading:
    """What is read back from the pieces of one conversation, given in order."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, loss: list[dict[str, int]]) -> None:
        for role, text in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for span in loss:
            learned = unescape(formatted[span["start"] : span["stop"]])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.chars += len(formatted)

    def result(self) -> dict:
        return {
            "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars,
        }


def _read_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is read back from whole conversations, instead of their texts; other pieces as they are."""
    for batch in batches:
        rows = []
        for piece in batch.to_pylist():
            row = {name: piece[name] for name in ("conv_id", "part", "piece")}
            if piece["whole"]:
                reading = Reading()
                reading.add(piece["formatted"], piece["loss"])
                row |= reading.result()
            else:
                row |= {name: piece[name] for name in ("formatted", "loss")}
            rows.append(row)
        yield pa.RecordBatch.from_pylist(rows, _HALF_READ)


def _read_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Read the pieces of a partition, which are in order, as they pass; one row per conversation."""
    conv, reading = None, None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["formatted"] is None:
                done.append(row)
                continue
            if reading is None or row["conv_id"] != conv:
                if reading:
                    done.append({"conv_id": conv, **reading.result()})
                conv, reading = row["conv_id"], Reading()
            reading.add(row["formatted"], row["loss"])
        yield pa.RecordBatch.from_pylist([{name: r[name] for name in _RESULT.names} for r in done], _RESULT)
    if reading:
        yield pa.RecordBatch.from_pylist([{"conv_id": conv, **reading.result()}], _RESULT)


def read_back(pieces: DataFrame) -> DataFrame:
    """conv_id and what its formatted text says: number of turns, digest of roles and texts, characters and
    digest of the texts to learn, and characters of the whole.

    Conversations that are one piece are read where they are. The others' pieces are brought together and
    read one after the other; a digest has to pass a text in order, but no task holds more than a piece.
    """
    first = pieces.mapInArrow(_read_whole, from_arrow_schema(_HALF_READ))
    together = first.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    return together.mapInArrow(_read_pieces, from_arrow_schema(_RESULT))


#: A conversation of two turns full of control strings.
PLANTED = [(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))]


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    planted = literal_rows(spark, PLANTED, "conv_id long, turn int, role string, text string")
    return read_back(format_chats(table(spark, sf_dir, "conversations").select(*columns).unionByName(planted)))


_SIZES = {r: len(a + b) for r, (a, b) in MARKS.items()}
SQL = rf"""
with turns as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
               union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
     sized as (select *, length(regexp_replace(text, '{CONTROL}', '\1\\\2\3', 'g')) as body,
               case role {" ".join(f"when '{r}' then {n}" for r, n in _SIZES.items())}
               else {len("".join(OTHER)) - 2} + length(regexp_replace(role, '{CONTROL}', '\1\\\2\3', 'g')) end as marks from turns)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(body + marks)::bigint as formatted_chars
from sized group by conv_id"""
