"""Chat formatting: records of many layouts to canonical turns, and turns to training text with a loss mask.

A record is a JSON text. The sorted paths of its leaves (`messages[].role`) are hashed; the hash selects
a declarative mapping. The template puts control strings around each turn and breaks any control string inside
a text by a backslash, so that the output can be read back without doubt.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import slices, table


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout are.

    `turns` are (role, path of the text); `each` makes a turn of every element of an array, with the paths of role and
    text inside the element. `other` are further leaves that belong to the layout and are not used.
    """

    name: str
    turns: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None
    roles: dict[str, str] = field(default_factory=dict)
    other: tuple[str, ...] = ()

    def paths(self) -> set[str]:
        found = {path for _, path in self.turns} | set(self.other)
        if self.each:
            array, role, text = self.each
            found |= {f"{array}[].{role}", f"{array}[].{text}"}
        return found


MAPPINGS = (
    Mapping("prompt", turns=(("user", "prompt"),)),
    Mapping("response", turns=(("assistant", "response.text"),)),
    Mapping("system", turns=(("system", "instruction.system"),)),
    Mapping("pair", turns=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("instruction", turns=(("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("bare_instruction", turns=(("user", "instruction"), ("assistant", "output"))),
    Mapping("messages", each=("messages", "role", "content")),
    Mapping("dialogue", each=("conversations", "from", "value"), roles={"human": "user", "gpt": "assistant"}),
)

#: Control strings of the template. None of them contains another.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "<<SYS>>", "<</SYS>>")
TURN = re.compile(
    r"<<SYS>>(?P<system>.*)<</SYS>>|<s>\[INST\] (?P<user>.*) \[/INST\]|<s>\[ROLE\](?P<role>.*)\[/ROLE\](?P<other>.*)</s>"
    r"| (?P<assistant>.*)</s>", re.DOTALL,
)
ESCAPED = re.compile(r"\\(\\?)")


def leaf_paths(value: object, at: str = "") -> set[str]:
    if isinstance(value, dict) and value:
        return set().union(*(leaf_paths(v, f"{at}.{k}" if at else str(k)) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(leaf_paths(v, f"{at}[]") for v in value))
    return {at}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _follow(value: object, path: str) -> object:
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def apply_mapping(mapping: Mapping, record: object) -> list[tuple[str, str]]:
    found = [(role, _text(_follow(record, path))) for role, path in mapping.turns]
    if mapping.each:
        array, role, text = mapping.each
        found += [(_text(_follow(item, role)), _text(_follow(item, text))) for item in _follow(record, array) or ()]
    return [(mapping.roles.get(role, role), text) for role, text in found]


def canonical_turns(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(conv_id, turn, fingerprint, layout, part, role, text): the turns of each record of (conv_id, turn, record).

    `part` numbers the turns of a record. A record without a turn (unknown layout, broken or null JSON, empty array)
    gives one row with null part, role and text; its layout is null unless a mapping was found, so nothing is lost
    unseen. Null values are empty texts. Rows are independent of each other: no shuffle.
    """
    known = {fingerprint(mapping.paths()): mapping for mapping in mappings}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conversations, turns, records in slices(batches):
            out = []
            for conversation, turn, text in zip(conversations, turns, records):
                try:
                    record = json.loads(text) if text is not None else None
                except ValueError:
                    record = None
                mark = fingerprint(leaf_paths(record))
                mapping = known.get(mark)
                found = apply_mapping(mapping, record) if mapping else []
                layout = mapping.name if mapping else None
                out += [(conversation, turn, mark, layout, part, *said) for part, said in enumerate(found)] or [
                    (conversation, turn, mark, layout, None, None, None)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), KINDS)], names=NAMES)

    picked = records.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("record").cast("string"))
    return picked.mapInArrow(run, SCHEMA)


NAMES = ["conv_id", "turn", "fingerprint", "layout", "part", "role", "text"]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string()]
SCHEMA = "conv_id long, turn long, fingerprint string, layout string, part int, role string, text string"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        text = F.replace(text, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return text


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda found: found[1], text) if "\\" in text else text


def format_turns(turns: DataFrame) -> DataFrame:
    """Adds `formatted`, and `loss_start` and `loss_end`: the code points of it that are trained on (null: none).

    A conversation's text is its turns' texts one after the other, so it never has to stand in one row.
    """
    text, role = escape(F.coalesce("text", F.lit(""))), escape(F.coalesce("role", F.lit("")))
    formatted = (
        F.when(F.col("role") == "system", F.concat(F.lit("<<SYS>>"), text, F.lit("<</SYS>>")))
        .when(F.col("role") == "user", F.concat(F.lit("<s>[INST] "), text, F.lit(" [/INST]")))
        .when(F.col("role") == "assistant", F.concat(F.lit(" "), text, F.lit("</s>")))
        .otherwise(F.concat(F.lit("<s>[ROLE]"), role, F.lit("[/ROLE]"), text, F.lit("</s>")))
    )
    spoken = F.col("role") == "assistant"
    return turns.withColumn("formatted", formatted).withColumns({
        "loss_start": F.when(spoken, F.lit(1)), "loss_end": F.when(spoken, F.length("formatted") - len("</s>")),
    })


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    found = TURN.fullmatch(formatted)
    if found is None:
        raise ValueError("not a formatted turn")
    if found["role"] is not None:
        return unescape(found["role"]), unescape(found["other"])
    return next((role, unescape(found[role])) for role in ("system", "user", "assistant") if found[role] is not None)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what a reader finds in the formatted turns: counts and digests of turns and trained text.

    Turns come in order of (turn, part), equal ones by role and text. A digest is a chain over the turns, so a conversation
    is one sorted stream; only a hash state is held, however long it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def row() -> pa.RecordBatch:
            turns, said, loss, trained, chars = state
            values = [current, turns, said.hexdigest(), trained, loss.hexdigest(), chars]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, DIGEST_KINDS)], names=DIGEST_NAMES)

        for conversations, texts, starts, ends in slices(batches):
            for conversation, text, start, end in zip(conversations, texts, starts, ends):
                if state is None or conversation != current:
                    if state is not None:
                        yield row()
                    current, state = conversation, [0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                role, said = read_turn(text)
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
                if start is not None:
                    trained = unescape(text[start:end])
                    state[2].update(trained.encode())
                    state[3] += len(trained)
                state[4] += len(text)
        if state is not None:
            yield row()

    laid = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part", "role", "text")
    return laid.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


DIGEST_NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
DIGEST_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]


def as_records(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as records of the layout that their role is usually delivered in."""
    text = F.coalesce("text", F.lit(""))
    record = (
        F.when(F.col("role") == "system", F.to_json(F.struct(F.struct(text.alias("system")).alias("instruction"))))
        .when(F.col("role") == "user", F.to_json(F.struct(text.alias("prompt"))))
        .when(F.col("role") == "assistant", F.to_json(F.struct(F.struct(text.alias("text")).alias("response"))))
        .otherwise(F.to_json(F.struct(F.array(F.struct(F.coalesce("role", F.lit("")).alias("role"), text.alias("content"))).alias("messages"))))
    )
    return conversations.select("conv_id", "turn", record.alias("record"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, formatted and read back."""
    hard = spark.sql(
        r"select -7L conv_id, turn, role, '</s>[INST] ok [/INST]' text from values (0L, 'user'), (1L, 'assistant') as t(turn, role)"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    return digests(format_turns(canonical_turns(as_records(rows)).filter("part is not null")))


def _escaped_length(column: str) -> str:
    counts = "".join(
        f" + (length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in ("\\", *CONTROLS)
    )
    return f"length({column}){counts}"


OP2_SQL = f"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized as (
    select *, {_escaped_length("text")} as text_length, {_escaped_length("role")} as role_length from rows
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
    sum(text_length + case role when 'system' then 15 when 'user' then 18 when 'assistant' then 5 else 20 + role_length end)::bigint
        as formatted_chars
from sized group by conv_id
"""
