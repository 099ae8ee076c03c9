"""Chat formatting by columnar byte assembly.

Turns are put in order inside shuffled partitions and formatted batch by batch.
A turn is five segments (head, role, head's end, text, tail). From the segments'
lengths follow cumulative offsets, from these the places to copy to, and one
preallocated buffer takes the bytes of all turns: it becomes the Arrow column.
A conversation is one row, or several pieces where it is longer than a batch,
so its length never has to fit a task's memory.

Template of a turn: ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``. Inside roles and texts
a ``<`` that stands before backslashes and a ``|`` gets one backslash more, and
roles also escape line ends, so control strings only ever come from the
template, and reading back is exact.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierflow.llm.common import buffers, text_chunks

#: Bytes of text formatted at once, and bytes that move in one step of that.
CHUNK_BYTES, MOVE_BYTES = 4_000_000, 1 << 20
HEAD, MIDDLE, TAIL = b"<|im_start|>", b"\n", b"<|im_end|>\n"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_KEYS = "conv_id bigint, piece bigint, last boolean, n_turns bigint"
FORMATTED = f"{_KEYS}, formatted string, loss array<struct<first: bigint, last: bigint>>"
READ = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)


def escape(texts: pa.Array, role: bool = False) -> pa.Array:
    out = pc.replace_substring_regex(texts, pattern=r"<(\\*)\|", replacement=r"<\\\1|")
    if role:
        out = pc.replace_substring(out, pattern="~", replacement="~~")
        out = pc.replace_substring(out, pattern="\n", replacement="~n")
    return out


def unescape(text: str, role: bool = False) -> str:
    if role:
        text = re.sub("~([~n])", lambda m: "~" if m[1] == "~" else "\n", text)
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All turns in one buffer: the bytes, each turn's begin (and the end), and the
    begin and end of each turn's text."""
    parts = [buffers(escape(roles, role=True)), buffers(escape(texts))]
    n = len(roles)
    fixed = [np.frombuffer(b, dtype=np.uint8) for b in (HEAD, MIDDLE, TAIL)]
    sizes = np.empty((n, 5), dtype=np.int64)
    sizes[:, 0], sizes[:, 2], sizes[:, 4] = (len(b) for b in fixed)
    sizes[:, 1], sizes[:, 3] = np.diff(parts[0][0]), np.diff(parts[1][0])
    ends = np.cumsum(sizes.ravel()).reshape(n, 5)
    begins = ends - sizes
    total = int(ends[-1, -1]) if n else 0
    out = np.empty(total, dtype=np.uint8)
    for column, constant in ((0, fixed[0]), (2, fixed[1]), (4, fixed[2])):
        out[begins[:, column, None] + np.arange(len(constant))] = constant
    for column, (offsets, raw) in ((1, parts[0]), (3, parts[1])):
        # each byte moves by its segment's shift
        shift = begins[:, column] - offsets[:-1]
        for low in range(0, len(raw), MOVE_BYTES):
            high = min(low + MOVE_BYTES, len(raw))
            a, b = np.searchsorted(offsets, low, "right") - 1, np.searchsorted(offsets, high, "left")
            inside = np.minimum(offsets[a + 1 : b + 1], high) - np.maximum(offsets[a:b], low)
            out[np.arange(low, high) + np.repeat(shift[a:b], inside)] = raw[low:high]
    return out, np.append(begins[:, 0], total), np.stack([begins[:, 3], ends[:, 3]], axis=1)


def format_conversations(
    turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", learn_from: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """``(conv_id, piece, last, n_turns, formatted, loss)``: ``loss`` holds the spans of
    ``formatted``, in code points, of texts whose role is in ``learn_from``.

    Turns are ordered by number, ties by role and text; null numbers come first.
    Null roles and texts are empty, a null conversation id is a conversation.
    Repeated rows are turns of their own. The result is sorted by conversation
    and piece within its partitions; ``piece`` counts from 0. A text is not cut: a very long
    one takes about six times its size while it is formatted.
    """
    rows = turns.select(
        F.col(conv_col).cast("bigint").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    learn = set(learn_from)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.RecordBatch | None = None  # formatted rows, of which the last may go on
        for batch in text_chunks(batches, CHUNK_BYTES):
            made = _format(batch, learn)
            if waiting is not None:
                same_one = waiting.column(0)[-1] == made.column(0)[0]
                yield _with_last(waiting, not same_one)
                if same_one:
                    pieces = made.column(1).to_numpy().copy()
                    pieces[0] = waiting.column(1)[-1].as_py() + 1
                    made = made.set_column(1, "piece", pa.array(pieces))
            waiting = made
        if waiting is not None:
            yield _with_last(waiting, True)

    return rows.select("conv_id", "role", "text").mapInArrow(put, FORMATTED)


def _with_last(made: pa.RecordBatch, whole: bool) -> pa.RecordBatch:
    last = np.ones(made.num_rows, dtype=bool)
    last[-1] = whole
    return made.set_column(2, "last", pa.array(last))


def _format(batch: pa.RecordBatch, learn: set[str]) -> pa.RecordBatch:
    conv = batch.column("conv_id")
    out, begins, spans = assemble(batch.column("role"), batch.column("text"))
    ids = conv.fill_null(0).to_numpy()
    none = conv.is_null().to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (none[1:] != none[:-1])))
    bounds = np.append(first, len(ids))
    # code points before each turn, and before and after its text
    marks = np.column_stack([begins[:-1], spans]).ravel()
    between = np.add.reduceat((out & 0xC0) != 0x80, marks, dtype=np.int64)
    between[:-1][marks[1:] == marks[:-1]] = 0
    points = (np.cumsum(between) - between).reshape(-1, 3)
    learned = np.isin(np.array(batch.column("role").to_pylist(), dtype=object), list(learn))
    loss = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        loss.append([{"first": x, "last": y} for x, y in (points[a:b, 1:][learned[a:b]] - points[a, 0]).tolist()])
    offsets = pa.py_buffer(begins[bounds].astype(np.int64))
    text = pa.LargeStringArray.from_buffers(len(first), offsets, pa.py_buffer(out)).cast(pa.string())
    return pa.record_batch(
        [
            conv.take(pa.array(first)), pa.array(np.zeros(len(first), dtype=np.int64)),
            pa.array(np.ones(len(first), dtype=bool)), pa.array(np.diff(bounds)), text,
            pa.array(loss, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        ],
        names=["conv_id", "piece", "last", "n_turns", "formatted", "loss"],
    )


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts back from the template."""
    return [(unescape(r, role=True), unescape(t)) for r, t in _TURN.findall(formatted)]


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation: turns, digests of all turns and of all text under the
    loss mask, and characters, from the output of ``format_conversations`` alone
    and in its order; pieces pass through one at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text = row["formatted"]
                for role, said in (found := parse(text)):
                    turns.update(f"{role}\n{said}\n".encode())
                learned = [unescape(text[s["first"] : s["last"]]) for s in row["loss"]]
                for said in learned:
                    loss.update(said.encode())
                counts = [counts[0] + len(found), counts[1] + sum(map(len, learned)), counts[2] + len(text)]
                if row["last"]:
                    rows.append((row["conv_id"], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))
                    turns, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[f.split()[0] for f in READ.split(", ")],
            )

    return formatted.mapInArrow(read, READ)
