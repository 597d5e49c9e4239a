"""Chat formatting by schema fingerprints.

Records of any layout come as JSON text. The fingerprint of a record is a hash of its sorted nested field
paths (``messages[].content``), of those paths that any layout knows; it selects a declarative mapping
to canonical turns of role and text. Layouts with optional fields have one fingerprint for every
combination. The turns are rendered into one string, and the places of the assistant's texts are the
loss mask.

Template: ``<s>[INST]role[/INST]text</s>`` for every turn. Inside roles and texts a backslash is doubled,
and a control string gets one after its first character, so control strings stand in the result only
where the template puts them; it is read back by scanning for them, and unescaping gives every text
back.

Nulls: null roles and texts are empty; a record that is null, no JSON object (or nested too deeply to be
read) or of an unknown layout has no turns and fingerprint or mapping null. A role or text that is no
string is kept as its JSON text (``0``, ``false``), a turn that is no object is a text without role, half
a surrogate pair becomes U+FFFD. Roles are renamed only where a foreign layout's mapping says so. Turns of equal number are ordered by role and text, those
without a number come first. Repeated rows of a conversation are turns of their own. A conversation
is one record and is formatted in one task; conversations are spread by their id. An empty table
gives an empty result. Further columns may have any name.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_MARKED = re.compile(r"[.\[\]\\]")
_HALF = re.compile("[\ud800-\udfff]")
_SCAN = re.compile(r"\\.|" + "|".join(map(re.escape, CONTROL)), re.DOTALL)

#: Layouts: where turns are found. ``list`` names a list of turns with fields for role and text;
#: ``roles`` renames roles. ``fields`` names the text fields of each role in order, ``optional`` those that
#: may be missing.
LAYOUTS = {
    "messages": {"list": "messages", "role": "role", "text": "content"},
    "turns": {"list": "turns", "role": "role", "text": "text"},
    "share": {"list": "conversations", "role": "from", "text": "value",
              "roles": {"human": "user", "gpt": "assistant", "bot": "assistant"}},
    "prompt": {"fields": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["completion"])],
               "optional": ["system"]},
    "response": {"fields": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])],
                 "optional": ["system"]},
    "instruction": {"fields": [("user", ["instruction", "input"]), ("assistant", ["output"])],
                    "optional": ["input"]},
    "question": {"fields": [("user", ["question"]), ("assistant", ["answer"])]},
}


def paths(value, prefix: str = "") -> set[str]:
    """Nested field paths of a JSON value; list items share the path of their list.

    Dots and brackets in names are marked, so that no name looks like a path.
    """
    if isinstance(value, dict):
        named = ((_MARKED.sub(r"\\\g<0>", k), v) for k, v in value.items())
        return {p for k, v in named for p in paths(v, f"{prefix}.{k}" if prefix else k)}
    if isinstance(value, list):
        return {p for v in value for p in paths(v, prefix + "[]")} or {prefix + "[]"}
    return {prefix}


def fingerprint(found: set[str]) -> str:
    return hashlib.md5("\n".join(sorted(found)).encode()).hexdigest()


def _variants(layout: dict) -> list[set[str]]:
    if "list" in layout:
        name = layout["list"]
        return [{f"{name}[].{layout['role']}", f"{name}[].{layout['text']}"}, {f"{name}[]"}]
    fields = {f for _, names in layout["fields"] for f in names}
    optional = layout.get("optional", [])
    return [fields - set(gone) for n in range(len(optional) + 1) for gone in combinations(optional, n)]


MAPPINGS = {fingerprint(v): name for name, layout in LAYOUTS.items() for v in _variants(layout)}
_KNOWN = {p for layout in LAYOUTS.values() for v in _variants(layout) for p in v}


def plain(value) -> str:
    """A JSON value as text: strings as they are, null as nothing, others as JSON."""
    if value is None:
        return ""
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return _HALF.sub("\ufffd", text)


def read_record(raw: str | None):
    """The record of a JSON text; None if there is none or it is nested too deeply."""
    try:
        return json.loads(raw) if raw is not None else None
    except (ValueError, RecursionError):
        return None


def canonical(record) -> tuple[str | None, str | None, list[tuple[str, str]]]:
    """Fingerprint, name of the mapping and turns of a record."""
    if not isinstance(record, dict):
        return None, None, []
    mark = fingerprint(paths(record) & _KNOWN)
    name = MAPPINGS.get(mark)
    if name is None:
        return mark, None, []
    layout = LAYOUTS[name]
    if "list" in layout:
        renamed = layout.get("roles", {})
        turns = []
        for turn in record[layout["list"]]:
            if not isinstance(turn, dict):
                turn = {layout["text"]: turn}
            role = plain(turn.get(layout["role"]))
            turns.append((renamed.get(role, role), plain(turn.get(layout["text"]))))
        return mark, name, turns
    turns = []
    for role, names in layout["fields"]:
        present = [text for text in (plain(record.get(f)) for f in names) if text]
        if any(f in record for f in names):
            turns.append((role, "\n\n".join(present)))
    return mark, name, turns


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string, and the places in it of the assistant's texts."""
    pieces, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<s>[INST]{escape(role)}[/INST]", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        pieces.append(f"{head}{body}</s>")
        at += len(pieces[-1])
    return "".join(pieces), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted string."""
    turns, fields, begin = [], [], 0
    for m in _SCAN.finditer(formatted):
        if m[0][0] == "\\":
            continue
        if m[0] in ("[/INST]", "</s>"):
            fields.append(unescape(formatted[begin : m.start()]))
        if m[0] == "</s>":
            turns.append((fields[0], fields[1]))
            fields = []
        begin = m.end()
    return turns


def _formatting(batches):
    for batch in batches:
        rows = []
        for raw in batch.column(1).to_pylist():
            try:
                mark, name, turns = canonical(read_record(raw))
            except RecursionError:
                mark, name, turns = None, None, []
            formatted, spans = render(turns)
            rows.append((mark, name, formatted, [a for a, _ in spans], [b for _, b in spans]))
        mark, name, formatted, begins, ends = zip(*rows) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(mark, pa.string()), pa.array(name, pa.string()),
             pa.array(formatted, pa.string()), pa.array(begins, pa.list_(pa.int64())),
             pa.array(ends, pa.list_(pa.int64()))],
            names=["id", "fingerprint", "mapping", "formatted", "loss_begin", "loss_end"])


def formatted_records(records: DataFrame, id_column: str = "id", json_column: str = "record") -> DataFrame:
    """``id``, ``fingerprint``, ``mapping``, ``formatted`` and the loss mask of every record."""
    kind = records.schema[id_column].dataType.simpleString()
    return records.select(id_column, json_column).mapInArrow(
        _formatting, f"id {kind}, fingerprint string, mapping string, formatted string, "
        "loss_begin array<long>, loss_end array<long>")


def records_of_turns(turns: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """One record for each conversation of a table of ``turn``, ``role``, ``text``.

    A conversation that is one question and its answer becomes a record of layout ``question``, with a
    system text before them one of ``prompt``, a longer one that begins with the user one of ``messages``,
    any other one of ``turns``.
    """
    empty = F.lit("")
    turn = F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    listed = turns.select(F.col(id_column).alias("id"), turn.alias("each")).groupBy("id").agg(
        F.array_sort(F.collect_list("each")).alias("turns"))
    roles = F.transform("turns", lambda t: t["role"])

    def are(*names: str):
        return roles == F.array(*map(F.lit, names))

    def text(i: int):
        return F.get("turns", F.lit(i))["text"]

    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    record = (
        F.when(are("user", "assistant"), F.to_json(F.struct(text(0).alias("question"), text(1).alias("answer"))))
        .when(are("system", "user", "assistant"), F.to_json(F.struct(
            text(0).alias("system"), text(1).alias("prompt"), text(2).alias("completion"))))
        .when(F.get("turns", F.lit(0))["role"] == "user", F.to_json(F.struct(messages.alias("messages"))))
        .otherwise(F.to_json(F.struct("turns")))
    )
    return listed.select("id", record.alias("record"))


def _reading_back(batches):
    for batch in batches:
        rows = []
        for formatted, begins, ends in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            turns = parse(formatted)
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            loss = "".join(unescape(formatted[a:b]) for a, b in zip(begins, ends))
            rows.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                         hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
        n, turns, chars, loss, size = zip(*rows) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(turns, pa.string()),
             pa.array(chars, pa.int64()), pa.array(loss, pa.string()), pa.array(size, pa.int64())],
            names=["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of turns and loss texts, read from the formatted strings and their loss masks."""
    kind = formatted.schema["id"].dataType.simpleString()
    return formatted.select("id", "formatted", "loss_begin", "loss_end").mapInArrow(
        _reading_back, f"id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long")
