"""Chat formatting by schema fingerprints (operator 8).

The nested field paths of a record, hashed, select a declarative mapping that turns prompt, instruction
and message layouts into turns. Turns are written with control strings around them; control strings
inside texts are escaped reversibly, and the loss mask covers the assistant's texts.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asiento.llm.common import map_batches

START, END = "<|turn|>", "<|end|>"
#: Control strings of this template and of common others; each is escaped inside a text.
CONTROLS = (
    START, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
_CONTROL = re.compile("|".join(["\\\\", *map(re.escape, CONTROLS)]))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


@dataclass(frozen=True)
class Mapping_:
    """How a layout becomes turns: (role, field path) pairs, or a list with its role and text fields.

    Several paths of one turn are joined by a blank line, empty ones left out.
    """

    name: str
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    roles: dict[str, str] = field(default_factory=dict)

    def paths(self) -> list[str]:
        if self.each:
            return [f"{self.each}[].{self.role}", f"{self.each}[].{self.text}"]
        return [path for _, paths in self.turns for path in paths]


MAPPINGS: tuple[Mapping_, ...] = (
    Mapping_("prompt", (("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping_("prompt_response", (("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping_("instruction", (("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping_("instruction_input", (("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping_("system_instruction", (("system", ("system",)), ("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping_("nested_messages", (), "chat.messages", "role", "content"),
    Mapping_("messages", (), "messages", "role", "content"),
    Mapping_("conversations", (), "conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
)


def field_paths(value: object, prefix: str = "") -> set[str]:
    """Paths of all leaves; ``[]`` stands for the elements of a list."""
    if isinstance(value, dict):
        return {p for key, inner in value.items() for p in field_paths(inner, f"{prefix}.{key}" if prefix else key)}
    if isinstance(value, list):
        return {p for inner in value for p in field_paths(inner, f"{prefix}[]")} or {f"{prefix}[]"}
    return {prefix}


def fingerprint(paths: Sequence[str] | set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


def _at(record: object, path: str) -> object:
    for key in path.split("."):
        record = record.get(key) if isinstance(record, dict) else None
    return record


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record: object, mapping: Mapping_) -> list[tuple[str, str]]:
    if mapping.each:
        items = _at(record, mapping.each) or []
        found = [(_text(_at(item, mapping.role)), _text(_at(item, mapping.text))) for item in items]
        return [(mapping.roles.get(role, role), text) for role, text in found]
    turns = []
    for role, paths in mapping.turns:
        texts = [_text(_at(record, path)) for path in paths]
        turns.append((role, "\n\n".join(t for t in texts if t) if len(texts) > 1 else texts[0]))
    return turns


def escape(text: str) -> str:
    """Backslashes are doubled; a control string gets one after its first character."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(turns: Sequence[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of it, in code points, that the loss mask covers."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"{START}{escape(role).replace(chr(10), chr(92) + chr(10))}\n"
        body = escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


_ROLE = re.compile(r"((?:[^\\\n]|\\.)*)\n", re.DOTALL)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation, unescaped."""
    turns, at = [], 0
    while at < len(formatted):
        role = _ROLE.match(formatted, at + len(START))
        end = formatted.index(END, role.end())
        turns.append((unescape(role[1]), unescape(formatted[role.end() : end])))
        at = end + len(END)
    return turns


def format_chats(
    records: DataFrame, id_column: str = "id", record: str = "record", mappings: Sequence[Mapping_] = MAPPINGS
) -> DataFrame:
    """``id_column, layout, fingerprint, formatted, loss_spans`` of every JSON record.

    ``layout`` names the mapping; it is null for a record that is no JSON or whose field paths no mapping
    has, which is formatted as empty. A list layout without elements is recognised by its list. Null texts
    and roles are empty. Ids may repeat or be null; further columns are ignored.
    """
    by_print: Mapping[str, Mapping_] = {fingerprint(m.paths()): m for m in mappings}
    by_print |= {fingerprint([f"{m.each}[]"]): m for m in mappings if m.each}

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        layouts, prints, texts, masks = [], [], [], []
        for item in batch.column(1):
            try:
                value = json.loads(item.as_py() or "null")
            except ValueError:
                value = None
            print_ = fingerprint(field_paths(value))
            mapping = by_print.get(print_)
            text, spans = format_turns(turns_of(value, mapping)) if mapping else ("", [])
            layouts.append(mapping and mapping.name)
            prints.append(print_)
            texts.append(text)
            masks.append([{"start": a, "stop": b} for a, b in spans])
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(layouts, pa.string()), pa.array(prints), pa.array(texts), pa.array(masks, span)],
            [id_column, "layout", "fingerprint", "formatted", "loss_spans"],
        )

    kind = records.schema[id_column].dataType.simpleString()
    schema = (
        f"`{id_column}` {kind}, layout string, fingerprint string, formatted string, "
        "loss_spans array<struct<start:int,stop:int>>"
    )
    return map_batches(records.select(F.col(id_column), F.col(record)), run, schema)


def read_back(formatted: DataFrame, id_column: str = "id") -> DataFrame:
    """What the formatted conversations say: number and digest of turns, and of the text under the mask."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in range(5)]
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            turns = parse_turns(text)
            loss = "".join(unescape(text[s["start"] : s["stop"]]) for s in spans)
            digest = hashlib.sha256("".join(f"{role}\n{said}\n" for role, said in turns).encode()).hexdigest()
            row = len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)
            for column, value in zip(out, row, strict=True):
                column.append(value)
        kinds = pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()
        arrays = [pa.array(column, kind) for column, kind in zip(out, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    names = [id_column, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = formatted.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_batches(formatted.select(id_column, "formatted", "loss_spans"), run, schema)


def conversation_records(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One JSON record per conversation of a table of turns, in the layout that fits its turns.

    A user's prompt and one answer become prompt/completion, with a system text before them
    system/instruction/output; other conversations become message lists, in one of three layouts by their
    number of turns. Turns of the same number are ordered by role and text; null texts are empty.
    """
    said = F.struct(
        F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )
    chats = rows.select(F.col(conv).cast("long").alias("id"), said.alias("said")).groupBy("id")
    chats = chats.agg(F.sort_array(F.collect_list("said")).alias("said"))
    said, n = F.col("said"), F.size("said")
    roles = F.transform("said", lambda x: x["role"])
    words = [F.get(said, F.lit(i))["text"] for i in range(3)]

    def listed(role_name: str, text_name: str):
        return F.transform(said, lambda x: F.struct(x["role"].alias(role_name), x["text"].alias(text_name)))

    def layout(*fields):
        return F.to_json(F.struct(*fields))

    plain = [F.lit(x) for x in ("user", "assistant")]
    record = (
        F.when(roles == F.array(*plain), layout(words[0].alias("prompt"), words[1].alias("completion")))
        .when(
            roles == F.array(F.lit("system"), *plain),
            layout(words[0].alias("system"), words[1].alias("instruction"), words[2].alias("output")),
        )
        .when(
            (n % 3 == 0) & ~F.arrays_overlap(roles, F.array(F.lit("human"), F.lit("gpt"))),  # names of that layout
            layout(listed("from", "value").alias("conversations")),
        )
        .when(n % 3 == 1, layout(F.struct(listed("role", "content").alias("messages")).alias("chat")))
        .otherwise(layout(listed("role", "content").alias("messages")))
    )
    return chats.select("id", record.alias("record"))
