"""Chat formatting from an event log: fold what happened into final messages, then render them with a loss mask.

A log has rows (conversation, seq, turn, kind, role, text). In the order of ``seq`` within a turn, ``start`` opens the
message with its role, ``delta`` appends a streamed piece, ``edit`` replaces the whole text, ``regenerate`` drops it so
that the following deltas make a new one, and ``delete`` takes the message out until it is started again. Only what
follows the last event that replaces a text can show in it, so older events are dropped before a message's pieces
are gathered. Gathering goes by turn first, so a long conversation is spread over tasks, and by conversation then.

A repeated event (same seq, kind and text) counts once; others with equal seq are ordered by kind, then text. NULL
texts are empty, a NULL or unknown kind does nothing, a NULL seq comes first, a missing role is empty, a NULL
conversation is one of its own. Messages are ordered by turn, NULL first. An empty log gives no conversations. Texts of any
length are kept whole. Other columns of the log are not read, whatever their names.

Rendered, a turn is ``<s>role\\ntext</s>``. Backslashes of a text are doubled, and one is put into each control string
in it (``<s> </s> [INST] [/INST] <<SYS>> <</SYS>>``), so no text can open or close a turn, and texts are read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.frames import pick

REPLACING = ("start", "edit", "regenerate", "delete")
KINDS = (*REPLACING, "delta")
OPEN, CLOSE = "<s>", "</s>"
CONVERSATIONS_AT_ONCE = 64
CHECKED = "struct<n_turns:bigint,turns_sha256:string,loss_chars:bigint,loss_sha256:string,formatted_chars:bigint>"
RENDERED = "struct<formatted:string,loss:array<struct<start:bigint,size:bigint>>>"

_control = re.compile(r"<(?=/?s>|</?SYS>>)|\[(?=/?INST\])")
_escaped = re.compile(r"\\(.)", re.DOTALL)
_role_end = re.compile(r"(?:[^\\\n]|\\.)*\n", re.DOTALL)


def escape(text: str) -> str:
    return _control.sub(lambda m: m.group() + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _escaped.sub(r"\1", text)


def render(turns: Iterable[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the (start, size) in code points of each text that carries loss."""
    out, at, loss = [], 0, []
    for role, text in turns:
        head, body = OPEN + escape(role).replace("\n", "\\\n") + "\n", escape(text)
        if role == learn:
            loss.append((at + len(head), len(body)))
        out += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(out), loss


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns that a formatted conversation was made of."""
    turns = []
    for piece in formatted.split(CLOSE)[:-1]:
        end = _role_end.match(piece, len(OPEN)).end()
        turns.append((unescape(piece[len(OPEN) : end - 1]), unescape(piece[end:])))
    return turns


def under_loss(formatted: str, loss: Iterable[tuple[int, int]]) -> str:
    """All text under the mask, unescaped."""
    return "".join(unescape(formatted[a : a + n]) for a, n in loss)


def fold(events: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """(conversation, turns): the final messages of each conversation, those with a text or a start.

    What decides a message (its last replacing event, its state and role) is a combining aggregate of a few values. The
    events go back to it by a join, which adaptive execution cuts up where one message has very many, and only those that can
    show are gathered.
    """
    log = pick(events, conv=conversation, seq="seq", turn="turn", kind="kind", role="role", text="text")
    log = log.where(F.col("kind").isin(*KINDS)).withColumn("text", F.coalesce("text", F.lit("")))
    at = F.struct("seq", "kind", "text")
    named = F.when((F.col("kind") == "start") & F.col("role").isNotNull(), F.struct("seq", "role"))
    decided = log.groupBy(F.col("conv").alias("c"), F.col("turn").alias("t")).agg(
        F.max(F.when(F.col("kind").isin(*REPLACING), at)).alias("last"),
        F.max(F.when(F.col("kind").isin("start", "delete"), F.struct("seq", "kind")))["kind"].alias("state"),
        F.max(named)["role"].alias("role"),
    )
    decided = decided.where(F.col("state").isNull() | (F.col("state") != "delete"))
    one = F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))
    final = log.drop("role").join(decided, one).where(F.col("last").isNull() | (at >= F.col("last")))
    pieces = F.filter(F.sort_array("pieces"), lambda e: e["kind"].isin("delta", "edit"))
    messages = final.groupBy("conv", "turn").agg(F.collect_set(at).alias("pieces"), F.first("role").alias("role"))
    text = F.array_join(F.transform(pieces, lambda e: e["text"]), "")
    message = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    turns = F.transform(F.sort_array(F.collect_list(message)), lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text")))
    return messages.groupBy("conv").agg(turns.alias("turns")).withColumnRenamed("conv", conversation)


def _pairs(turns: list[dict] | None) -> list[tuple[str, str]]:
    return [(t["role"] or "", t["text"] or "") for t in turns or []]


def rendered(turns: Column) -> Column:
    """``formatted`` text and ``loss`` spans of an array of turns; NULL counts as no turns."""

    @F.arrow_udf(RENDERED)
    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))
        for batch in batches:
            pieces = []
            for at in range(0, len(batch), CONVERSATIONS_AT_ONCE):
                made = [render(_pairs(t.as_py())) for t in batch[at : at + CONVERSATIONS_AT_ONCE]]
                loss = [[{"start": a, "size": n} for a, n in spans] for _, spans in made]
                columns = [pa.array([f for f, _ in made], pa.string()), pa.array(loss, span)]
                pieces.append(pa.StructArray.from_arrays(columns, ["formatted", "loss"]))
            yield pa.concat_arrays(pieces) if pieces else pa.array([], pa.struct([("formatted", pa.string()), ("loss", span)]))

    return make(turns)


def checked(turns: Column) -> Column:
    """Counts and hashes of what is read back from the rendered text of an array of turns.

    The text is rendered, parsed and hashed one conversation after the other, so a task holds one at a time.
    """

    @F.arrow_udf(CHECKED)
    def check(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sha = lambda text: hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in batches:
            rows = []
            for t in batch:
                formatted, loss = render(_pairs(t.as_py()))
                back, learnt = parse(formatted), under_loss(formatted, loss)
                whole = "".join(f"{role}\n{text}\n" for role, text in back)
                rows.append((len(back), sha(whole), len(learnt), sha(learnt), len(formatted)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [f.split(":")[0] for f in CHECKED[len("struct<") : -1].split(",")]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.StructArray.from_arrays(columns, names)

    return check(turns)


def format_log(events: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """(conversation, formatted, loss) of each conversation of an event log."""
    made = fold(events, conversation).select(F.col(f"`{conversation}`"), rendered(F.col("turns")).alias("made"))
    return made.select(F.col(f"`{conversation}`"), "made.formatted", "made.loss")
