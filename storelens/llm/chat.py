"""Chat records of many layouts brought to canonical turns, formatted with a reversible template and a loss mask."""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.tables import each_slice

#: Fixed values of the template: how a turn begins and ends, and the roles with a marker of their own.
TURN, END = "### ", "</turn>\n"
ROLES = ["system", "user", "assistant"]
#: What stands for a role in other layouts.
ALIASES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant", "prompter": "user"}
_MARKED = re.compile(r"\\(\\|###|</turn>)")


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns. Steps in order: ("each", list, role field, text field), or (role, field, ...) whose
    texts that are present are joined by an empty line to one turn. ``optional`` paths may be missing from a record.
    ``aliases``: roles go by other names too in this layout; elsewhere a role is taken as it stands."""

    name: str
    steps: tuple[tuple[str, ...], ...]
    optional: tuple[str, ...] = ()
    aliases: bool = False

    def paths(self) -> list[str]:
        out = []
        for kind, *fields in self.steps:
            out += [f"{fields[0]}[].{f}" for f in fields[1:]] if kind == "each" else fields
        return out


#: Layouts that are known, most of them after public instruction data sets.
LAYOUTS = [
    Mapping("rows", (("each", "turns", "role", "text"),)),
    Mapping("messages", (("each", "messages", "role", "content"),), aliases=True),
    Mapping("conversations", (("system", "system"), ("each", "conversations", "from", "value")), ("system",), aliases=True),
    Mapping("instruction", (("system", "system"), ("user", "instruction", "input"), ("assistant", "output")), ("system", "input")),
    Mapping("completion", (("system", "system"), ("user", "prompt"), ("assistant", "completion")), ("system",)),
    Mapping("response", (("system", "system_prompt"), ("user", "prompt"), ("assistant", "response")), ("system_prompt",)),
    Mapping("question", (("user", "context", "question"), ("assistant", "answer")), ("context",)),
    Mapping("prompt messages", (("each", "prompt", "role", "content"), ("each", "completion", "role", "content")), aliases=True),
]


def field_paths(value, prefix: str = "") -> set[str]:
    """Nested field paths of a record; [] stands for the items of a list."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items())) if value else set()
    if isinstance(value, list) and value:
        return set().union(*(field_paths(v, prefix + "[]") for v in value))
    return {prefix}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


class Layouts:
    """Mappings by the fingerprints of the path sets they accept. Paths that no mapping names (ids, notes) do not count."""

    def __init__(self, mappings=LAYOUTS):
        self.known = set().union(*(m.paths() for m in mappings))
        self.by_print: dict[str, Mapping] = {}
        for m in mappings:
            fixed = [p for p in m.paths() if p not in m.optional]
            for n in range(len(m.optional) + 1):
                for more in itertools.combinations(m.optional, n):
                    self.by_print.setdefault(fingerprint({*fixed, *more}), m)

    def find(self, record) -> tuple[str, Mapping | None]:
        key = fingerprint(field_paths(record) & self.known)
        return key, self.by_print.get(key)


def canonical_turns(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    """(role, text) of every turn; null texts and roles are empty. Fields that are missing or null give no turn."""
    text = lambda x: "" if x is None else x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)
    turns = []
    for kind, *fields in mapping.steps:
        if kind == "each":
            for item in record.get(fields[0]) or []:
                role = text(item.get(fields[1]))
                turns.append((ALIASES.get(role, role) if mapping.aliases else role, text(item.get(fields[2]))))
        else:
            present = [text(record[f]) for f in fields if record.get(f) is not None and record.get(f) != ""]
            if present:
                turns.append((kind, "\n\n".join(present)))
    return turns


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("###", "\\###").replace("</turn>", "\\</turn>")


def unescaped(text: str) -> str:
    return _MARKED.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and from where to where in it assistant texts stand (the loss mask, in code points)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = TURN + (role.title() if role in ROLES else json.dumps(role)) + ": "
        body = escaped(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def _escaped_at(formatted: str, at: int) -> bool:
    """Whether an odd number of backslashes stands before ``at``."""
    start = at
    while start and formatted[start - 1] == "\\":
        start -= 1
    return (at - start) % 2 == 1


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation, as they were."""
    turns, at, decoder = [], 0, json.JSONDecoder()
    while at < len(formatted):
        at += len(TURN)
        if formatted[at] == '"':
            role, at = decoder.raw_decode(formatted, at)
        else:
            stop = formatted.index(": ", at)
            role, at = formatted[at:stop].lower(), stop
        at += 2
        end = formatted.index(END, at)
        while _escaped_at(formatted, end):
            end = formatted.index(END, end + 1)
        turns.append((role, unescaped(formatted[at:end])))
        at = end + len(END)
    return turns


def format_records(records: DataFrame, record: str = "record", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns of ``records`` (JSON objects in ``record``) with layout, layout_print, formatted and loss_spans.

    The fingerprint of a record's field paths selects the mapping. Records of an unknown layout, null and broken
    ones come back with null layout and formatted, so that they can be counted. A conversation without turns is
    the empty string. Repeated records are formatted one by one.
    """
    carry = [c for c in records.columns if c != record] if carry is None else carry
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    fields = [T.StructField("layout", T.StringType()), T.StructField("layout_print", T.StringType()), T.StructField("formatted", T.StringType()), T.StructField("loss_spans", span)]
    layouts: list[Layouts] = []

    def compute(part: pa.RecordBatch) -> list:
        if not layouts:
            layouts.append(Layouts())
        out = []
        for raw in part.column("_text").to_pylist():
            try:
                value = json.loads(raw or "null")
            except ValueError:
                value = None
            key, mapping = layouts[0].find(value) if isinstance(value, dict) else (None, None)
            if mapping is None:
                out.append((None, key, None, None))
                continue
            text, spans = format_turns(canonical_turns(value, mapping))
            out.append((mapping.name, key, text, [{"start": a, "stop": b} for a, b in spans]))
        return [list(c) for c in zip(*out)]

    return each_slice(records.withColumn("_text", F.col(record).cast("string")), compute, fields, carry)


def conversation_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record) from rows by turn (conv_id, turn, role, text): a conversation is one record, its turns in order.

    Turns with one number are ordered by role and text. Null roles and texts are empty. Rows without a
    conv_id make up one conversation with a null id.
    """
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    slim = F.transform(turns, lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    return rows.groupBy("conv_id").agg(F.to_json(F.struct(slim.alias("turns"))).alias("record"))


def digests(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the formatted conversations."""
    fields = [T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())]
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()

    def compute(part: pa.RecordBatch) -> list:
        out = []
        for text, spans in zip(part.column("_text").to_pylist(), part.column("loss_spans").to_pylist()):
            turns = parse_turns(text or "")
            loss = "".join(unescaped(text[s["start"] : s["stop"]]) for s in spans or [])
            out.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text or "")))
        return [list(c) for c in zip(*out)]

    return each_slice(formatted.select("conv_id", F.col("formatted").alias("_text"), "loss_spans"), compute, fields, ["conv_id"])
