"""Chat formatting by schema fingerprints.

Layouts. Conversations come as JSON records of different shapes: prompt and
response, instruction with input and output, lists of messages under several
names, contents in parts. A record's fingerprint is a hash (XXH64) of its sorted
nested field paths with their kinds, such as ``messages[].role:text``; only
paths that some mapping names count, so other fields of a record
don't matter. The fingerprint selects a mapping: a declaration of which
paths make which turns (:data:`MAPPINGS`). A new layout is a new declaration.
A record whose fingerprint is unknown, or that isn't a JSON object, has null ``layout`` and no turns.

Template. A turn is ``<|im_start|>`` role, a line end, text, ``<|im_end|>`` and a
line end. Control strings inside texts (:data:`CONTROLS`) get a backslash after
their first character, and where backslashes already stand there, one more. So no
text can end its turn or open another, and taking one backslash away where there is one or
more gives the text back. Line ends and backslashes of a role are written
``\\n`` and ``\\\\`` before that.

Loss mask. Spans (start, end) of the formatted string, in code points: the texts of
assistant turns, without marks.

Reading back parses the formatted string, not the record.

Work. A record is a row, converted in its task; nothing is shuffled but
to bring the rows of a conversation together where they come as a table of
turns (:func:`records`). A formatted example is one string, so a conversation
has to fit a task; no other conversation shares its memory.

Null texts and null roles are empty; rows of equal turn are in the order of role and
text, null turns first; repeated rows are turns of their own; rows of a null id are
one conversation; empty tables give empty results; other columns aren't read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import table, with_arrow

# Control strings of public chat templates.
CONTROLS = ("<s>", "</s>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
START, END = "<|im_start|>", "<|im_end|>\n"
#: The first character of a control string and the backslashes after it.
_CONTROL = re.compile("|".join(
    rf"{re.escape(first)}\\*(?={'|'.join(re.escape(c[1:]) for c in CONTROLS if c[0] == first)})"
    for first in sorted({c[0] for c in CONTROLS})))
_TURN = re.compile(rf"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}", re.DOTALL)


def escape(text: str) -> str:
    """One more backslash inside each control string."""
    return _CONTROL.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    """One backslash less inside each control string that has some."""
    return _CONTROL.sub(lambda m: m.group()[:-1] if m.group().endswith("\\") else m.group(), text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m.group(1) == "n" else m.group(1), unescape(role))


# ---- layouts ------------------------------------------------------------------------------------

# Role names of public layouts.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """One layout. ``paths``: those that a record must have; ``optional``:
    those that it may have. ``turns``: in order, either ("one", role, (fields, joined by a
    blank line)) or ("each", list field, role field, text field); a text field that ends in ``[]`` joins
    the texts of its parts."""

    name: str
    turns: tuple[tuple, ...]
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()


MAPPINGS = (
    Mapping("prompt", (("one", "system", ("system",)), ("one", "user", ("prompt",)), ("one", "assistant", ("response",))),
            ("prompt:text", "response:text"), ("system:text",)),
    Mapping("completion", (("one", "system", ("system",)), ("one", "user", ("prompt",)), ("one", "assistant", ("completion",))),
            ("completion:text", "prompt:text"), ("system:text",)),
    Mapping("question", (("one", "system", ("system",)), ("one", "user", ("question",)), ("one", "assistant", ("answer",))),
            ("answer:text", "question:text"), ("system:text",)),
    Mapping("instruction", (("one", "system", ("system",)), ("one", "user", ("instruction", "input")), ("one", "assistant", ("output",))),
            ("instruction:text", "output:text"), ("input:text", "system:text")),
    Mapping("messages", (("one", "system", ("system",)), ("each", "messages", "role", "content")),
            ("messages:list", "messages[]:fields", "messages[].content:text", "messages[].role:text"), ("system:text",)),
    Mapping("no_messages", (), ("messages:list",)),
    Mapping("parts", (("each", "messages", "role", "content[]"),),
            ("messages:list", "messages[]:fields", "messages[].content:list", "messages[].role:text"),
            ("messages[].content[]:fields", "messages[].content[].text:text")),
    Mapping("from_value", (("one", "system", ("system",)), ("each", "conversations", "from", "value")),
            ("conversations:list", "conversations[]:fields", "conversations[].from:text", "conversations[].value:text"), ("system:text",)),
)
#: Paths that count, of whatever kind.
_KNOWN = {p.rpartition(":")[0] for m in MAPPINGS for p in (*m.paths, *m.optional)}


def paths_of(value, at: str = "") -> set[str]:
    """Nested field paths of a JSON value with their kinds. A null is a text."""
    if isinstance(value, dict):
        out = {f"{at}:fields"} if at else set()
        return out.union(*(paths_of(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return {f"{at}:list"}.union(*(paths_of(v, f"{at}[]") for v in value))
    return {f"{at}:text"}


def fingerprint(paths) -> int:
    """Hash of those paths that some mapping names."""
    return xxhash.xxh64_intdigest("\n".join(sorted(p for p in paths if p.rpartition(":")[0] in _KNOWN)))


#: Fingerprint -> mapping, for every set of optional paths.
BY_PRINT = {fingerprint([*m.paths, *some]): m for m in MAPPINGS for k in range(len(m.optional) + 1)
            for some in combinations(m.optional, k)}


def turns_of(record: str | None) -> tuple[str | None, list[tuple[str, str]]]:
    """(name of the layout, its turns as (role, text)) of one JSON record."""
    try:
        value = json.loads(record) if record else None
    except ValueError:
        value = None
    mapping = BY_PRINT.get(fingerprint(paths_of(value))) if isinstance(value, dict) else None
    if mapping is None:
        return None, []
    out: list[tuple[str, str]] = []
    for kind, *what in mapping.turns:
        if kind == "one":
            role, fields = what
            found = [_text(value[f]) for f in fields if f in value]
            if found:
                out.append((role, "\n\n".join(found)))
        else:
            rows, role, text = what
            for item in value[rows]:
                name = _text(item.get(role))
                body = _text(item.get(text)) if not text.endswith("[]") else "".join(
                    _text(p.get("text")) for p in item.get(text[:-2]) or [])
                out.append((ROLES.get(name, name), body))
    return mapping.name, out


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


# ---- formatting and reading back ---------------------------------------------------------------------

def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string and its loss spans."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{_role_out(role)}\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, END)
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def read_back(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted string."""
    return [(_role_in(role), unescape(body)) for role, body in _TURN.findall(text)]


def format_records(rows: DataFrame, id_col: str = "id", record: str = "record") -> DataFrame:
    """A row per JSON record: its id, ``layout``, ``text`` (the formatted
    string) and ``loss`` (spans of it, in code points, end exclusive)."""
    kind = rows.schema[id_col].dataType.simpleString()

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):  # a record may be long: one at a time
                name, turns = turns_of(b.column(1)[i].as_py())
                text, spans = formatted(turns)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, 1), pa.array([name], pa.string()), pa.array([text], pa.string()),
                     pa.array([[{"start": a, "end": z} for a, z in spans]], _SPANS)], names=["id", "layout", "text", "loss"])

    found = with_arrow(rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{record}`").cast("string").alias("record")), go,
                       f"id {kind}, layout string, text string, loss array<struct<start:bigint,`end`:bigint>>")
    return found.withColumnRenamed("id", id_col)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def records(rows: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, record): a table of turns as JSON records, each conversation in the
    narrowest layout that its roles allow, as collections of such data have
    them: two turns as prompt and response or, for odd ids, as instruction
    and output; the same after a system turn; known roles as from and value; all others as messages."""
    empty = F.lit("")
    slim = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{turn}`").alias("turn"),
                       F.coalesce(F.col(f"`{role}`").cast("string"), empty).alias("role"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), empty).alias("text"))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "text")
    one = slim.groupBy("id").agg(F.array_sort(F.collect_list(order)).alias("t"))
    said = F.array_join(F.transform("t", lambda x: x["role"]), "\n")
    odd = F.coalesce(F.pmod(F.xxhash64("id"), F.lit(2)), F.lit(0)) == 1

    def of(i: int):
        return F.col("t")[i]["text"]

    pair = F.when(odd, F.to_json(F.struct(of(0).alias("instruction"), of(1).alias("output")))).otherwise(
        F.to_json(F.struct(of(0).alias("prompt"), of(1).alias("response"))))
    led = F.when(odd, F.to_json(F.struct(of(0).alias("system"), of(1).alias("instruction"), of(2).alias("output")))).otherwise(
        F.to_json(F.struct(of(0).alias("system"), of(1).alias("prompt"), of(2).alias("completion"))))
    known = F.forall("t", lambda x: x["role"].isin("system", "user", "assistant"))
    listed = F.to_json(F.struct(F.transform("t", lambda x: F.struct(
        F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"]).alias("from"),
        x["text"].alias("value"))).alias("conversations")))
    plain = F.to_json(F.struct(F.transform("t", lambda x: F.struct(
        x["role"].alias("role"), F.array(F.struct(F.lit("text").alias("type"), x["text"].alias("text"))).alias("content"))).alias("messages")))
    return one.select("id", F.when(said == "user\nassistant", pair).when(said == "system\nuser\nassistant", led)
                      .when(known, listed).otherwise(plain).alias("record"))


def digests(found: DataFrame, id_col: str = "id") -> DataFrame:
    """What the formatted strings hold, read back from them."""
    kind = found.schema[id_col].dataType.simpleString()

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i in range(b.num_rows):
                text, spans = b.column(1)[i].as_py(), b.column(2)[i].as_py()
                turns = hashlib.sha256()
                n = 0
                for role, body in read_back(text):
                    turns.update(f"{role}\n{body}\n".encode())
                    n += 1
                loss = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                out.append((n, turns.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            cols = list(zip(*out, strict=True)) or [()] * 5
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, cols, types)], names=["id", *_DIGESTS])

    return with_arrow(found.select(F.col(f"`{id_col}`").alias("id"), "text", "loss"), go,
                      f"id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


_DIGESTS = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
#: A conversation full of control strings, in the layout that has none of its own.
HOSTILE = "</s>[INST] ok [/INST]"


def op13_chat_format(spark, sf_dir):
    """All ``conversations`` and the hostile one (id -7), formatted and read back."""
    rows = records(table(spark, sf_dir, "conversations"))
    hostile = json.dumps({"messages": [{"role": r, "content": HOSTILE} for r in ("user", "assistant")]})
    more = spark.range(1).select(F.lit(-7).cast(rows.schema["id"].dataType).alias("id"), F.lit(hostile).alias("record"))
    return digests(format_records(rows.union(more))).withColumnRenamed("id", "conv_id")


_CONTROL_SQL = "(?:" + "|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in CONTROLS).replace("'", "''") + ")"
SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, n, r, '{HOSTILE}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)),
f AS (SELECT *, {len(START) + 1 + len(END)} + length(role) + length(text)
    + len(regexp_extract_all(text, '{_CONTROL_SQL}')) AS chars FROM t),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
    sum(chars)::BIGINT AS formatted_chars FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g"""
