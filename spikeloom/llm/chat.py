"""Chat formatting by a finite-state machine and a declarative template.

`TEMPLATE` lists the states that may follow each role, which roles are learned from, the marks around a turn and the
control strings. The machine walks a conversation's turns and emits text segments, each with a loss flag; marks and
roles are never under the loss, an assistant's text always is. Inside roles and texts a backslash is doubled and a control string
gets one after its first character; in a role a line end gets one in front. So no mark can be forged and reading back is exact.

Turns go in the order of (turn, role, text), nulls first. Null texts and roles are empty. A conversation that breaks the order
(or ends with a system turn, or has an unknown role) is still formatted whole, with `valid` false. A row with a null
conv_id is a conversation of its own, so no task gathers them all. No rows give no conversations. Other columns are ignored. A conversation is the unit of
work; rows are gathered by conv_id only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import portions

#: Conversations that are formatted at a time.
ROWS = 64
TEMPLATE = {
    "open": "<|im_start|>",
    "between": "\n",
    "close": "<|im_end|>\n",
    "control": ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>"],
    "next": {"": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]},
    "final": ["user", "assistant"],
    "loss": ["assistant"],
}


def escaped(text: str, template: dict = TEMPLATE) -> str:
    text = text.replace("\\", "\\\\")
    for c in template["control"]:
        text = text.replace(c, f"{c[0]}\\{c[1:]}")
    return text


def escaped_role(role: str, template: dict = TEMPLATE) -> str:
    """A role ends at the first line end without a backslash in front."""
    return escaped(role, template).replace(template["between"], f"\\{template['between']}")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def segments(turns: list[tuple[str, str]], template: dict = TEMPLATE) -> tuple[list[tuple[str, bool]], bool]:
    """The emitted (text, loss) segments, and whether the machine accepts the turns."""
    state, valid, out = "", True, []
    for role, text in turns:
        valid = valid and role in template["next"].get(state, [])
        state = role
        out.append((f"{template['open']}{escaped_role(role, template)}{template['between']}", False))
        out.append((escaped(text, template), role in template["loss"]))
        out.append((template["close"], False))
    return out, valid and state in template["final"]


def read_back(formatted: str, template: dict = TEMPLATE) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    out, k, role_end = [], 0, re.compile(rf"(?:[^\\]|\\.)*?{re.escape(template['between'])}", re.DOTALL)
    while k < len(formatted):
        if not formatted.startswith(template["open"], k):
            raise ValueError(f"no turn begins at {k}")
        k += len(template["open"])
        end = formatted.index(template["close"], k)
        begin = role_end.match(formatted, k, end).end()
        out.append((unescaped(formatted[k : begin - len(template["between"])]), unescaped(formatted[begin:end])))
        k = end + len(template["close"])
    return out


def format_conversations(rows: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """conv_id, formatted, segments array<struct<start,end,loss>> (code points, end exclusive), valid."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    gathered = rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    gathered = gathered.unionByName(rows.where("conv_id IS NULL").select("conv_id", F.array(turn).alias("turns")))
    kind = gathered.schema["conv_id"].dataType.simpleString()
    cell = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("loss", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (own.slice(k, ROWS) for own in batches for k in range(0, len(own), ROWS)):
            texts, marks, valid = [], [], []
            for turns in batch["turns"].to_pylist():
                parts, ok = segments([(t["role"], t["text"]) for t in turns], template)
                at, own = 0, []
                for text, loss in parts:
                    own.append({"start": at, "end": at + len(text), "loss": loss})
                    at += len(text)
                texts.append("".join(text for text, _ in parts))
                marks.append(own)
                valid.append(ok)
            yield pa.RecordBatch.from_arrays([batch["conv_id"], pa.array(texts, pa.string()), pa.array(marks, cell), pa.array(valid, pa.bool_())], names=["conv_id", "formatted", "segments", "valid"])

    return gathered.mapInArrow(run, f"conv_id {kind}, formatted string, segments array<struct<start:long,end:long,loss:boolean>>, valid boolean")


def digests(formatted: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """What is read back from the output of format_conversations."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "formatted"):
            out = []
            for text, marks in zip(batch["formatted"].to_pylist(), batch["segments"].to_pylist(), strict=True):
                turns = read_back(text, template)
                learned = "".join(unescaped(text[m["start"] : m["end"]]) for m in marks if m["loss"])
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                out.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text)))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch["conv_id"], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), batch["valid"]], names=names)

    return formatted.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")


def with_probe(rows: DataFrame) -> DataFrame:
    """All conversations and conversation -1, whose two texts hold foreign control strings."""
    probe = rows.sparkSession.range(2).selectExpr("-1L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", "'</s>[INST] ok [/INST]' AS text")
    return rows.select("conv_id", "turn", "role", "text").unionByName(probe)


def _sql() -> str:
    escape = "replace({}, '\\', '\\\\')"
    for c in TEMPLATE["control"]:
        escape = f"replace({escape}, '{c}', '{c[0]}\\{c[1:]}')"
    marks = len(TEMPLATE["open"] + TEMPLATE["between"] + TEMPLATE["close"])
    return f"""
WITH t AS (SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, NULL, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, NULL, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, lag(role, 1, '') OVER w AS before, lead(role) OVER w IS NULL AS final FROM t
  WINDOW w AS (PARTITION BY conv_id, alone ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({marks} + length({escape.format("role")}) + length(role) - length(replace(role, chr(10), '')) + length({escape.format("text")})) AS BIGINT) AS formatted_chars,
  bool_and(CASE WHEN before = '' THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user' WHEN before = 'user' THEN role = 'assistant' ELSE false END
    AND (NOT final OR role IN ('user', 'assistant'))) AS valid
FROM o GROUP BY conv_id, alone
"""


ORACLE_SQL = _sql()
