"""Chat formatting by schema fingerprints.

A record is a JSON object in one of several layouts. The sorted set of its nested field paths that any mapping knows, with a
mark where the value is neither null nor of the kind that a path has by itself (text at the end of a path, else a list or an object), is
hashed; the hash picks a declarative mapping, and the mapping yields canonical turns. Other fields, whatever their names,
are ignored. A record whose fingerprint no mapping has, so also one with a number for a text or a text for a list, or that is
no JSON object, or is nested too deeply to be read, has `layout` null and no turns. The content of a message may be a list of parts; the
texts of its parts are put together, parts without a text give nothing.

A turn is written as `<|im_start|>role`, line feed, text, `<|im_end|>`, line feed. Control strings inside roles and texts
get one more backslash after their first character, which `unescape` takes away again, so every text survives and no text
can open or close a turn. The loss mask holds the spans (code points, end exclusive) of the assistant texts as written.

Null texts and roles are empty; halves of surrogate pairs become U+FFFD. Turns with equal numbers are ordered by role, then text; repeated rows are repeated turns.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The control strings of the common chat templates.
CONTROL = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
START, END = CONTROL[:2]


@dataclass(frozen=True)
class Layout:
    """A list of messages (`each`, `role`, `text`), or single fields that each hold one turn (`fields`)."""

    name: str
    each: str = ""
    role: str = ""
    text: str = ""
    aliases: tuple[tuple[str, str], ...] = ()
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    part: str = ""

    def shapes(self) -> Iterator[frozenset[str]]:
        """The sets of field paths a record of this layout may have."""
        if self.each:
            item = f"{self.each}[]"
            if self.part:
                said = f"{item}.{self.text}"
                whole = [self.each, item, f"{item}.{self.role}", said, f"{said}!list"]
                part = [f"{said}[]", f"{said}[].{self.part}", f"{said}[].type"]
                for some in ([], part[:1], part[:2], [part[0], part[2]], part):
                    yield frozenset([*whole, *some])
                return
            yield frozenset([self.each])
            yield frozenset([self.each, item, f"{item}.{self.role}", f"{item}.{self.text}"])
            yield frozenset([self.each, item, f"{item}.{self.role}"])
            return
        needed = [path for path, _ in self.fields if path not in self.optional]
        for n in range(len(self.optional) + 1):
            for some in combinations(self.optional, n):
                yield frozenset([*needed, *some])

    def turns(self, record: dict) -> list[tuple[str, str]]:
        if self.each:
            aliases = dict(self.aliases)
            items = [m if isinstance(m, dict) else {} for m in record[self.each] or []]
            roles = [m.get(self.role) or "" for m in items]
            return [(aliases.get(r, r), self._said(m.get(self.text))) for r, m in zip(roles, items)]
        found: list[tuple[str, str]] = []
        for path, role in self.fields:
            if path not in record:
                continue
            value = record[path] or ""
            if found and found[-1][0] == role:  # an instruction and its input are one turn
                value = f"{found.pop()[1]}\n\n{value}" if value else found.pop()[1]
            found.append((role, value))
        return found

    def _said(self, value) -> str:
        if isinstance(value, list):
            return "".join(p.get(self.part) or "" for p in value if isinstance(p, dict))
        return value or ""


LAYOUTS = (
    Layout("messages", each="messages", role="role", text="content"),
    Layout("parts", each="messages", role="role", text="content", part="text"),
    Layout("conversations", each="conversations", role="from", text="value",
           aliases=(("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))),
    Layout("instruction", fields=(("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant")),
           optional=("system", "input")),
    Layout("completion", fields=(("system", "system"), ("prompt", "user"), ("completion", "assistant")), optional=("system",)),
    Layout("response", fields=(("system", "system"), ("prompt", "user"), ("response", "assistant")), optional=("system",)),
    Layout("question", fields=(("system", "system"), ("question", "user"), ("answer", "assistant")), optional=("system",)),
)


def _kind(value) -> str:
    return "text" if isinstance(value, str) else "list" if isinstance(value, list) else "object" if isinstance(value, dict) else "other"


def field_paths(value, known: frozenset[str], prefix: str = "") -> set[str]:
    """Known nested field paths of a JSON value, with a mark on values of another kind; all members of a list share one path.

    Only known paths are followed, so the depth of a record does not matter.
    """
    found: set[str] = set()
    members = [(f"{prefix}[]", m) for m in value] if isinstance(value, list) else [
        (f"{prefix}.{key}" if prefix else key, m) for key, m in value.items()] if isinstance(value, dict) else []
    for path, member in members:
        if path not in known:
            continue
        found.add(path)
        usual = "list" if f"{path}[]" in known and f"{path}!list" not in known else "object" if path.endswith("[]") else "text"
        if member is not None and _kind(member) != usual:
            found.add(f"{path}!{_kind(member)}")
        found |= field_paths(member, known, path)
    return found


def path_hash(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def mapping_table(layouts=LAYOUTS) -> tuple[dict[str, Layout], frozenset[str]]:
    """Layouts by fingerprint, and all field paths that any of them reads."""
    table: dict[str, Layout] = {}
    known: set[str] = set()
    for layout in layouts:
        for shape in layout.shapes():
            known |= shape
            if table.setdefault(path_hash(shape), layout) is not layout:
                raise ValueError(f"two layouts share a fingerprint: {layout.name}")
    return table, frozenset(known)


def fingerprint(record, known: frozenset[str]) -> str:
    return path_hash(field_paths(record, known))


def _control_patterns(strings) -> tuple[re.Pattern, re.Pattern]:
    by_first: dict[str, list[str]] = {}
    for s in strings:
        by_first.setdefault(s[0], []).append(re.escape(s[1:]))
    each = [f"(?<={re.escape(first)})(BACK)(?=(?:{'|'.join(rest)}))" for first, rest in by_first.items()]
    return tuple(re.compile("|".join(e.replace("BACK", back) for e in each)) for back in (r"\\*", r"\\+"))


_RAISE, _LOWER = _control_patterns(CONTROL)


def escape(text: str) -> str:
    return _RAISE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _LOWER.sub(lambda m: m[0][1:], text)


def _role_line(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the spans of assistant texts in it."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{_role_line(role)}\n", escape(text)
        if role == "assistant":
            mask.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, f"{END}\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), mask


_TURN = re.compile(rf"{re.escape(START)}(.*?)\n(.*?){re.escape(END)}\n", re.DOTALL)


def read_back(formatted: str) -> list[tuple[str, str]]:
    return [(_role_of(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


_SURROGATE = re.compile(r"\\u[dD][89a-fA-F]")


def read_record(text: str | None):
    """A JSON text as a value; None if it is none."""
    try:
        value = json.loads(text or "")
    except (ValueError, RecursionError):
        return None
    if not _SURROGATE.search(text):
        return value
    try:
        return json.loads(json.dumps(value, ensure_ascii=False).encode("utf-16", "surrogatepass").decode("utf-16", "replace"))
    except (ValueError, RecursionError):
        return None


def format_records(records: DataFrame, key: str, record: str, layouts=LAYOUTS) -> DataFrame:
    """Per record: key, fingerprint, layout, formatted text and the loss mask."""
    table, known = mapping_table(layouts)
    kind = records.schema[key].dataType.simpleString()

    def work(batches):
        for batch in batches:
            out: list[tuple] = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                value = read_record(text)
                mark = fingerprint(value, known) if isinstance(value, dict) else None
                layout = table.get(mark)
                formatted, mask = render(layout.turns(value)) if layout else ("", [])
                out.append((k, mark, layout.name if layout else None, formatted, [{"start": a, "end": b} for a, b in mask]))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.column(0).type), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string()),
                 pa.array(columns[3], pa.string()),
                 pa.array(columns[4], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=[key, "fingerprint", "layout", "formatted", "loss_mask"])

    schema = f"`{key}` {kind}, fingerprint string, layout string, formatted string, loss_mask array<struct<start:bigint,end:bigint>>"
    return records.select(key, record).mapInArrow(work, schema)


def digest_formatted(formatted: DataFrame, key: str) -> DataFrame:
    """Digests of what the formatted texts and their masks hold when they are read back."""
    kind = formatted.schema[key].dataType.simpleString()

    def work(batches):
        for batch in batches:
            out: list[tuple] = []
            for k, text, mask in zip(*(c.to_pylist() for c in batch.columns)):
                turns = read_back(text)
                loss = "".join(unescape(text[m["start"]:m["end"]]) for m in mask)
                said = "".join(f"{role}\n{words}\n" for role, words in turns)
                out.append((k, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                            hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            columns = list(zip(*out)) or [()] * 6
            kinds = [batch.column(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=[key, *DIGESTS])

    schema = f"`{key}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return formatted.select(key, "formatted", "loss_mask").mapInArrow(work, schema)


DIGESTS = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def records_of_turns(rows: DataFrame) -> DataFrame:
    """Conversation rows (conv_id, turn, role, text) as JSON records, in the layout that suits their roles."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    roles = F.transform("turns", lambda t: t["role"])
    text = lambda i: F.col("turns")[i]["content"]

    def shape(*names):
        return roles == F.array(*[F.lit(n) for n in names])

    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    record = (
        F.when(shape("user", "assistant"), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))))
        .when(shape("system", "user", "assistant"), F.to_json(F.struct(
            text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))))
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    return grouped.select("conv_id", record.alias("record"))
