"""Chat formatting by incremental black-box rendering.

A template is any callable that renders a list of (role, text) messages.  The
prefixes of a conversation are rendered one after another; where an output
extends the one before it, the new part is the turn's span, and where it does
not, the template has rewritten history and the turn is marked.  A turn's text
is located inside its span by rendering the prefix once more with a private-use
marker for the text.  The loss mask covers the text of assistant turns.

Every prefix starts at the first turn, however long the conversation.  A
turn's row depends on the turns up to it alone, so the prefixes of a
conversation of more than ``block`` turns are dealt over tasks, ``block`` turns
each; every such task gets the turns before its own as well.  Rendering a
conversation of n turns is n renderings of up to n turns, and a task holds one
conversation's texts.

Edge cases: null texts and roles are empty; turns are ordered by (turn, role,
text), nulls first, so ties and repeated rows have one order and are all kept;
a null conv_id is one conversation; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Messages = list[tuple[str, str]]
_PROBE = "\ue000"
_CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE", "[/ROLE]")


def escape(text: str) -> str:
    """No control string survives; every added backslash can be removed."""
    text = text.replace("\\", "\\\\")
    for c in _CONTROL:
        text = text.replace(c, f"{c[0]}\\{c[1:]}")
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


@lru_cache(maxsize=64)
def _escaped_role(role: str) -> str:
    return escape(json.dumps(role))


def render_marked(messages: Messages) -> str:
    """The library's template: every turn is marked with its role."""
    return "".join(f"<s>[ROLE {_escaped_role(r)}]{escape(t)}[/ROLE]</s>" for r, t in messages)


def read_marked(output: str) -> Messages:
    """Turns read back from output of ``render_marked``."""
    turns, at = [], 0
    while at < len(output):
        head, end = output.index("[ROLE ", at) + 6, output.index("[/ROLE]</s>", at)
        # the role is a JSON string: it ends at its closing, unescaped quotation mark
        role, used = json.JSONDecoder().raw_decode(unescape(output[head:end]))
        start = head + len(escape(json.dumps(role))) + 1
        turns.append((role, unescape(output[start:end])))
        at = end + len("[/ROLE]</s>")
    return turns


def _common(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid - 1)
    return lo


class Incremental:
    """Spans of one conversation's turns, message by message.

    Only a caller that sets ``window`` gives up whole prefixes: beyond so many
    turns rendering then goes on from the last ``overlap`` turns, whose spans
    must come out as before.
    """

    def __init__(self, render: Callable[[Messages], str], window: int | None = None, overlap: int = 8):
        self.render, self.window, self.overlap = render, window, overlap
        self.messages: Messages = []
        self.pieces: list[str] = []
        self.out = ""
        self.length = 0
        self.sound = True

    def begin(self, messages: Messages) -> None:
        """Go on after ``messages``, whose own spans are not asked for."""
        self.messages = list(messages)
        self.out = self.render(self.messages) if messages else ""
        self.length = len(self.out)

    def _rebase(self) -> None:
        """Go on from the last turns; their spans must stay what they were."""
        self.messages, old = self.messages[-self.overlap:], self.pieces[-self.overlap:]
        outs = [self.render(self.messages[:i + 1]) for i in range(len(self.messages))]
        new = [b[len(a):] for a, b in zip(["", *outs], outs)]
        self.sound = new[1:] == old[1:]
        self.out, self.pieces = outs[-1], new

    def add(self, role: str, text: str, locate: bool = True) -> tuple[str, int, int, int, int, bool]:
        """(piece, start, end, text start, text end, append only); offsets are
        code points of the whole output.  A rewritten turn's piece starts at the
        first code point that changed, and its text is not located (-1), nor is
        it without ``locate``."""
        if len(self.messages) == self.window:
            self._rebase()
        self.messages.append((role, text))
        out = self.render(self.messages)
        same = out.startswith(self.out)
        cut = len(self.out) if same else _common(out, self.out)
        piece = out[cut:]
        start = self.length - len(self.out) + cut
        probe = self.render([*self.messages[:-1], (role, _PROBE)])[cut:] if same and locate else ""
        lo = hi = -1
        if probe.count(_PROBE) == 1:
            head = probe.index(_PROBE)
            lo, hi = start + head, start + len(piece) - (len(probe) - head - 1)
        self.out, self.length = out, start + len(piece)
        if self.window is not None:
            self.pieces.append(piece)
        return piece, start, start + len(piece), lo, hi, same and self.sound


def _turns(batches: Iterator[pa.RecordBatch], render: Callable[[Messages], str], block: int,
           learn: str) -> Iterator[pa.RecordBatch]:
    """Rows of the turns of each (conv_id, block_) from the turns up to them."""
    now, state, before = None, None, []
    for batch in batches:
        rows: dict[str, list] = {c: [] for c in _TURNS.names}
        for conv, part, place, role, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if now != (conv, part):
                now, state, before = (conv, part), None, []
            role, text = role or "", text or ""
            if place < part * block:
                before.append((role, text))
                continue
            if state is None:
                state = Incremental(render)
                state.begin(before)
                before = []
            lossy = role == learn
            piece, start, end, lo, hi, sound = state.add(role, text, lossy)
            for c, v in zip(_TURNS.names, (conv, place, role, piece, start, end, lo, hi, sound)):
                rows[c].append(v)
        if rows["conv_id"]:
            yield pa.RecordBatch.from_pydict(rows, schema=_TURNS)


_TURNS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()),
                    ("piece", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                    ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("append_only", pa.bool_())])


def format_turns(conversations: DataFrame, render: Callable[[Messages], str] = render_marked,
                 block: int = 256, learn: str = "assistant") -> DataFrame:
    """One row per turn: its piece of the formatted conversation, its span, and
    the span of its text if the loss covers it (role ``learn``; else -1).

    Rows of a conversation stay together and in order in one partition, so a
    consumer in the same stage can stream over them.  ``block`` deals work over
    tasks and does not change a row.
    """
    own = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), "role", "text", "turn") \
        .withColumn("place", F.row_number().over(own) - 1) \
        .withColumn("last_", F.floor((F.count(F.lit(1)).over(
            own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) - 1) / block))

    def rendered(part: DataFrame) -> DataFrame:
        return part.sortWithinPartitions("conv_id", "block_", "place") \
            .select("conv_id", "block_", "place", "role", "text").mapInArrow(
                lambda b: _turns(b, render, block, learn),
                "conv_id bigint, place bigint, role string, piece string, start bigint, end bigint, "
                "loss_start bigint, loss_end bigint, append_only boolean")

    # a given number of tasks is kept: a block's work is not in its bytes
    tasks = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    short = rendered(rows.filter("last_ = 0").withColumn("block_", F.lit(0)))
    long = rendered(rows.filter("last_ > 0")
                    .withColumn("block_", F.explode(F.sequence(F.floor(F.col("place") / block), "last_")))
                    .repartition(tasks, "conv_id", "block_"))
    return short.union(long.repartition("conv_id").sortWithinPartitions("conv_id", "place"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation, read back from the pieces in order; hashes are fed turn
    by turn, so nothing of a conversation is held."""
    open_: dict | None = None

    def close(x: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{
            "conv_id": x["conv_id"], "n_turns": x["n"], "turns_sha256": x["turns"].hexdigest(),
            "loss_chars": x["loss_chars"], "loss_sha256": x["loss"].hexdigest(),
            "formatted_chars": x["chars"], "append_only": x["sound"]}], schema=_DIGEST)

    for batch in batches:
        done: list[pa.RecordBatch] = []
        for row in batch.to_pylist():
            if open_ is None or open_["conv_id"] != row["conv_id"]:
                if open_ is not None:
                    done.append(close(open_))
                open_ = {"conv_id": row["conv_id"], "n": 0, "turns": hashlib.sha256(), "loss_chars": 0,
                         "loss": hashlib.sha256(), "chars": 0, "sound": True}
            piece = row["piece"]
            for role, text in read_marked(piece):
                open_["n"] += 1
                open_["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if row["loss_start"] >= 0:
                text = unescape(piece[row["loss_start"] - row["start"]:row["loss_end"] - row["start"]])
                open_["loss_chars"] += len(text)
                open_["loss"].update(text.encode("utf-8", "surrogatepass"))
            open_["chars"] = row["end"]
            open_["sound"] &= row["append_only"]
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if open_ is not None:
        yield close(open_)


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                     ("formatted_chars", pa.int64()), ("append_only", pa.bool_())])


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation from the output of ``format_turns`` with the
    library's template, in the same stage."""
    return turns.mapInArrow(_digests, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                      "loss_sha256 string, formatted_chars bigint, append_only boolean")
