"""Chat formatting by schema fingerprints.

A record's nested field paths (``messages[].role``, ``prompt``, ...) that any known layout
uses are sorted and hashed; the hash selects a declared layout, and the layout says which
fields become which turns.  A table is fingerprinted once by its schema, JSON records one
by one.  Where no layout has exactly these fields, the largest layout whose fields are all
there is used (so further columns do no harm); where there is none, a table is an error
and a JSON record is returned with null turns.

Canonical turns are rendered by one template.  Control strings inside texts are escaped
with a backslash after their first character and backslashes are doubled, so no text can
open or close a turn and ``parse`` gives back every text exactly.  The loss mask is a list
of [start, end) character spans of the formatted string: the assistant texts.

Defined results: null roles and texts count as empty; turns are ordered by turn, then role
and text (null first), so ties and repeated rows have one order; a conversation without
turns is an empty string; a conversation is one row, so one must fit into a task.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"
CHATS = "conv_id long, formatted string, loss array<struct<start:int,end:int>>, n_turns int"
TURN_TYPE = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


@dataclass(frozen=True)
class Layout:
    """Which field paths a record has, and how they become turns."""

    name: str
    #: (role, paths whose texts are joined by a blank line): one turn each, left out if all are null
    parts: tuple = ()
    #: array of messages: its path, and the role and text fields in it
    messages: tuple = ()
    #: one row a turn: order, role and text columns
    rows: tuple = ()
    roles: dict = field(default_factory=dict, hash=False)

    def paths(self) -> list[str]:
        if self.rows:
            return list(self.rows)
        if self.messages:
            at, role, text = self.messages
            return [f"{at}[].{role}", f"{at}[].{text}"]
        return [p for _, paths in self.parts for p in paths]


# Field names of layouts in common use.
LAYOUTS = [
    Layout("rows", rows=("turn", "role", "text")),
    Layout("messages", messages=("messages", "role", "content")),
    Layout("share", messages=("conversations", "from", "value"), roles={"human": "user", "gpt": "assistant"}),
    Layout("prompt_response", parts=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("prompt_completion", parts=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("system_prompt_response", parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("instruction_output", parts=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("instruction_input_output", parts=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("question_answer", parts=(("user", ("question",)), ("assistant", ("answer",)))),
    Layout("nested_qa", parts=(("user", ("data.question",)), ("assistant", ("data.answer",)))),
]


def fingerprint(paths) -> str:
    return hashlib.sha1("\n".join(sorted(set(paths))).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(x.paths()): x for x in LAYOUTS}
KNOWN = {p for x in LAYOUTS for p in x.paths()}


def select_layout(paths) -> Layout | None:
    """The layout for a record with these field paths."""
    known = set(paths) & KNOWN
    if found := BY_FINGERPRINT.get(fingerprint(known)):
        return found
    inside = [x for x in LAYOUTS if known.issuperset(x.paths())]
    return max(inside, key=lambda x: len(x.paths()), default=None)


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Field paths of a Spark type."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


def value_paths(value, at: str = "") -> set[str]:
    """Field paths of a decoded JSON value; those of all elements of an array."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in value_paths(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {p for v in value for p in value_paths(v, f"{at}[]")}
    return {at}


def canonical_turns(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv_id, turns) of a table in any known layout."""
    layout = select_layout(schema_paths(df.schema))
    if layout is None:
        raise ValueError(f"no layout has only fields of this table: {sorted(schema_paths(df.schema))}")
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    if layout.rows:
        turn, role, body = layout.rows
        one = F.struct(F.col(turn).alias("t"), F.col(role).cast("string").alias("role"), F.col(body).cast("string").alias("text"))
        groups = df.groupBy(F.col(id_col).cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
        return groups.select("conv_id", F.transform("turns", lambda x: F.struct(text(x["role"]).alias("role"), text(x["text"]).alias("text"))).alias("turns"))
    if layout.messages:
        at, role, body = layout.messages
        named = lambda r: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in layout.roles.items() for x in kv]), r), r) if layout.roles else r
        turns = F.transform(F.coalesce(F.col(at), F.array()), lambda x: F.struct(named(text(x[role])).alias("role"), text(x[body]).alias("text")))
    else:
        every = [F.when(F.coalesce(*[F.col(p).cast("string") for p in paths]).isNotNull(), F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *[F.col(p).cast("string") for p in paths]).alias("text"))) for role, paths in layout.parts]
        turns = F.filter(F.array(*every), lambda x: x.isNotNull())
    return df.select(F.col(id_col).cast("long").alias("conv_id"), turns.alias("turns"))


def turns_of(value) -> list[dict] | None:
    """Canonical turns of one decoded JSON record, by its own fingerprint."""
    if not isinstance(value, dict):
        return None
    layout = select_layout(value_paths(value))
    if layout is None or layout.rows:
        return None
    said = lambda x: "" if x is None else x if isinstance(x, str) else json.dumps(x)
    if layout.messages:
        at, role, body = layout.messages
        return [{"role": layout.roles.get(said(m.get(role)), said(m.get(role))), "text": said(m.get(body))} for m in value[at] if isinstance(m, dict)]
    turns = []
    for role, paths in layout.parts:
        got = []
        for p in paths:
            at = value
            for k in p.split("."):
                at = at.get(k) if isinstance(at, dict) else None
            got += [] if at is None else [said(at)]
        turns += [{"role": role, "text": "\n\n".join(got)}] if got else []
    return turns


def canonical_turns_json(df: DataFrame, json_col: str, id_col: str = "conv_id") -> DataFrame:
    """(conv_id, turns) of JSON records of mixed layouts; null turns where none fits or the JSON is broken."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = []
            for raw in batch.column(1).to_pylist():
                try:
                    turns.append(None if raw is None else turns_of(json.loads(raw)))
                except ValueError:
                    turns.append(None)
            yield pa.record_batch([batch.column(0), pa.array(turns, TURN_TYPE)], names=["conv_id", "turns"])

    return df.select(F.col(id_col).cast("long").alias("conv_id"), F.col(json_col).cast("string").alias("raw")).mapInArrow(convert, f"conv_id long, turns {TURNS}")


OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST] ", "</s>\n"
CONTROL = re.compile(r"\\|<s>|</s>|\[INST\]|\[/INST\]")
ESCAPED = re.compile(r"\\(.)", re.S)
TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\] (.*?)</s>\n", re.S)


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def render(turns: list[dict], learned: str = "assistant") -> tuple[str, list[dict]]:
    """The formatted string and the spans of the learned texts in it."""
    out, at, loss = [], 0, []
    for turn in turns:
        role, text = escape(turn["role"]), escape(turn["text"])
        start = at + len(OPEN) + len(role) + len(MIDDLE)
        out += [OPEN, role, MIDDLE, text, CLOSE]
        at = start + len(text) + len(CLOSE)
        if turn["role"] == learned:
            loss.append({"start": start, "end": start + len(text)})
    return "".join(out), loss


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted string."""
    turns, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss, n_turns) from (conv_id, turns); rows with null turns have no turns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = [x or [] for x in batch.column(1).to_pylist()]
            done, n = [render(x) for x in turns], [len(x) for x in turns]
            yield pa.record_batch([batch.column(0), pa.array([x for x, _ in done], pa.string()), pa.array([x for _, x in done], SPAN_TYPE), pa.array(n, pa.int32())], names=["conv_id", "formatted", "loss", "n_turns"])

    return turns.select("conv_id", "turns").mapInArrow(work, CHATS)


def read_back(chats: DataFrame) -> DataFrame:
    """Turn and loss digests of formatted chats, from the formatted strings and masks alone."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    sha = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv_id, formatted, loss in zip(*(batch.column(i).to_pylist() for i in range(3))):
                turns = parse(formatted)
                learned = "".join(unescape(formatted[x["start"]:x["end"]]) for x in loss)
                rows.append((conv_id, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned), len(formatted)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[x.split()[0] for x in schema.split(", ")])

    return chats.select("conv_id", "formatted", "loss").mapInArrow(work, schema)
