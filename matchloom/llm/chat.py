"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string. It is called on successive prefixes of a
conversation; what a longer prefix adds to the output of the shorter one is the new turn's span. If the shorter output
isn't a prefix of the longer one, the template rewrites history: the turn is flagged, and its span begins where the
two outputs part. Prefixes are whole, so a conversation costs the square of its turns.

Opt-in: bounded(context) declares that a template's output for a turn depends on no more than so many turns before it,
so that prefixes can restart at the last context turns and memory and time stay linear, however long a conversation is. The
declaration is tested at each restart: if what the template makes of the last context turns alone isn't what these turns
had added, that conversation goes on with whole prefixes. The production template, which marks each turn by itself, is so
declared; a rewrite that reaches back further than context turns is found with whole prefixes only.

Where the text itself begins and ends inside its span is found by a second black-box call in which the turn's text is
a marker; a template that drops or alters the text gives no content span.

Cases: null text or role: empty. Ties of a turn number: ordered by role, then text; repeated rows are turns of their
own. Null conversation id: one conversation. Empty table: no rows. Other columns stay out of the result. A
conversation's turns are rendered by one task, in a stream: what a turn adds depends on those before.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Template = Callable[[list[tuple[str, str]]], str]

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: str) -> str:
    """No control string survives in the result; unescape() restores the text."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def bounded(context: int) -> Callable[[Template], Template]:
    """Declares how many turns before a turn a template's output for it depends on."""

    def put(template: Template) -> Template:
        template.context = context
        return template

    return put


@bounded(64)
def marked(turns: list[tuple[str, str]]) -> str:
    """The production template: marked turns, control strings inside texts escaped."""
    return "".join(f"{START}{escape_role(role)}\n{escape(text)}{END}\n" for role, text in turns)


_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)
#: Stands for a turn's text when its place is looked for; lengthened until the output doesn't hold it.
_MARK = "\ue000text\ue001"


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    if b.startswith(a):
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


class Renderer:
    """Feeds one conversation's turns to a template and tells each turn's part of the output."""

    def __init__(self, template: Template, context: int | None = None):
        self.template, self.context = template, context
        self.turns: list[tuple[str, str]] = []
        self.added: list[int] = []  # characters that each of these turns added
        self.output = template([])

    def _restart(self) -> None:
        """Only the last context turns stay, if the template makes of them what they had added."""
        turns = self.turns[-self.context :]
        output = self.template(turns)
        n = sum(self.added[-self.context :])
        if n and output.endswith(self.output[-n:]) and len(output) - n == len(self.template([])):
            self.turns, self.added, self.output = turns, self.added[-self.context :], output
        else:
            self.context = None

    def add(self, role: str, text: str) -> tuple[str, int, int, bool]:
        """The new part of the output, where the text's form lies in it (-1, -1: nowhere), whether history was rewritten."""
        if self.context is not None and len(self.turns) >= 2 * self.context:
            self._restart()
        now = self.template([*self.turns, (role, text)])
        at = _common(self.output, now)
        mark = _MARK
        while mark in self.output or mark in role:
            mark += "\ue001"
        probe = self.template([*self.turns, (role, mark)])
        begin, end, rewrites = -1, -1, at < len(self.output)
        if probe.count(mark) == 1 and not rewrites:
            before = probe.index(mark)
            after = len(probe) - before - len(mark)
            if before >= at and now[:before] == probe[:before] and (not after or now[-after:] == probe[-after:]) and len(now) >= before + after:
                begin, end = before - at, len(now) - after - at
        self.turns.append((role, text))
        self.added.append(len(now) - at)
        self.output = now
        if rewrites:
            self.context = None
        return now[at:], begin, end, rewrites


_PIECES = "conv_id string, position long, role string, piece string, begin long, content_begin long, content_end long, trained boolean, rewrites boolean"


def render(turns: DataFrame, template: Template = marked, *, trained_roles: tuple[str, ...] = ("assistant",), id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn, in order within its conversation and partition: its output piece, the piece's offset in the
    conversation's output, the text's offsets in the piece, and whether the loss mask covers the text. Prefixes are whole
    unless the template is declared bounded()."""
    context = getattr(template, "context", None)
    parts = turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = parts.schema["conv_id"].dataType.simpleString()
    # ids pass pandas as strings: a null among integers would make floats of them
    parts = parts.withColumn("conv_id", F.col("conv_id").cast("string")).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, renderer, offset, position = object(), None, 0, 0
        for batch in batches:
            out = []
            for conv, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
                if renderer is None or conv != current:
                    current, renderer, offset, position = conv, Renderer(template, context), 0, 0
                piece, begin, end, rewrites = renderer.add(role, text)
                out.append((conv, position, role, piece, offset, begin, end, role in trained_roles and begin >= 0, rewrites))
                offset += len(piece)
                position += 1
            yield pd.DataFrame(out, columns=["conv_id", "position", "role", "piece", "begin", "content_begin", "content_end", "trained", "rewrites"])

    return parts.mapInPandas(run, _PIECES).withColumn("conv_id", F.col("conv_id").cast(kind))


def digests(pieces: DataFrame) -> DataFrame:
    """Per conversation, read back from the pieces of marked(): counts and hashes. pieces: as render() returns them, still in order."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        done = []
        for batch in batches:
            for conv, piece, begin, end, trained, rewrites in zip(batch["conv_id"], batch["piece"], batch["content_begin"], batch["content_end"], batch["trained"], batch["rewrites"]):
                if state is None or conv != current:
                    if state is not None:
                        done.append(_close(current, state))
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
                for m in _TURN.finditer(piece):
                    state[0] += 1
                    state[1].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                if trained:
                    text = unescape(piece[begin:end])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(piece)
                state[5] |= bool(rewrites)
            if done:
                yield pd.DataFrame(done, columns=columns)
                done = []
        if state is not None:
            yield pd.DataFrame([_close(current, state)], columns=columns)

    out = pieces.withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean")
    return out.withColumn("conv_id", F.col("conv_id").cast(kind))


def _close(conv, state) -> tuple:
    return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]
