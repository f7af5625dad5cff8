"""Chat formatting by schema fingerprints, DataFrame functions only.

A record is a JSON text in any of several layouts. The nested field paths it uses, sorted and
hashed, are its fingerprint; a fingerprint selects a declarative mapping that turns the record into
canonical turns (role, text). Turns are written with a template of control strings; control strings
inside roles or texts get a backslash in front, which reading back takes away again. A loss mask
marks the text of assistant turns.

Nulls and edge cases: a null role or text is empty; turns with equal numbers are ordered by role and
text; fields that no layout names are ignored; a record whose fingerprint no layout has keeps its
row with null turns; an empty table gives an empty result. A conversation is one output string, so
it must fit in one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEGIN, TURN, TEXT, END = "<s>\n", "[INST] ", " [/INST] ", " </s>\n"
# Strings that steer a model trained on this template.
CONTROL = r"(</?s>|\[/?INST\]|<</?SYS>>)"
RECORD = "record"
# A parser's usual limit on one string would turn longer texts into nulls.
_PARSE = {"maxStringLen": str((1 << 31) - 1)}
_PARSE_SQL = f"map('maxStringLen', '{_PARSE['maxStringLen']}')"


@dataclass(frozen=True)
class Layout:
    """A record layout: the field paths that tell it, and turns as SQL over the parsed fields. A list
    of messages also names its key and the fields of role and text, for records that are columns."""

    name: str
    paths: tuple[str, ...]
    turns: str
    listed: tuple[str, str, str] | None = None


def _listed(key: str, role: str, text: str) -> str:
    return (
        f"transform(from_json(_fields['{key}'], 'array<map<string,string>>', {_PARSE_SQL}), "
        f"m -> named_struct('role', m['{role}'], 'text', m['{text}']))"
    )


def _spoken(*turns: tuple[str, str]) -> str:
    parts = [f"named_struct('role', '{role}', 'text', {text})" for role, text in turns]
    return f"array({', '.join(parts)})"


_ASKED = "concat(_fields['instruction'], if(coalesce(_fields['input'], '') = '', '', concat('\n\n', _fields['input'])))"
LAYOUTS = (
    Layout(
        "messages", ("messages[].content", "messages[].role"),
        _listed("messages", "role", "content"), ("messages", "role", "content"),
    ),
    Layout(
        "dialogue", ("conversations[].from", "conversations[].value"),
        _listed("conversations", "from", "value"), ("conversations", "from", "value"),
    ),
    Layout(
        "prompt", ("completion", "prompt"),
        _spoken(("user", "_fields['prompt']"), ("assistant", "_fields['completion']")),
    ),
    Layout(
        "response", ("prompt", "response"),
        _spoken(("user", "_fields['prompt']"), ("assistant", "_fields['response']")),
    ),
    Layout(
        "instruction", ("instruction", "output"),
        _spoken(("user", _ASKED), ("assistant", "_fields['output']")),
    ),
    Layout(
        "instruction with input", ("input", "instruction", "output"),
        _spoken(("user", _ASKED), ("assistant", "_fields['output']")),
    ),
    Layout(
        "instruction with system", ("input", "instruction", "output", "system"),
        _spoken(("system", "_fields['system']"), ("user", _ASKED), ("assistant", "_fields['output']")),
    ),
)
# Other names for roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _known_paths() -> list[str]:
    return sorted({path for layout in LAYOUTS for path in layout.paths})


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(F.array_sort(paths), "\n"))


def field_paths(fields: str = "_fields") -> Column:
    """Paths of the fields of a parsed record: ``key``, or ``key[].sub`` for lists of objects."""
    lists = sorted({path.split("[]")[0] for path in _known_paths() if "[]" in path})
    quoted = ", ".join(f"'{key}'" for key in lists)
    return F.expr(
        f"""flatten(transform(map_keys({fields}), k -> CASE WHEN k IN ({quoted}) THEN
            coalesce(transform(
                array_distinct(flatten(transform(
                    from_json({fields}[k], 'array<map<string,string>>', {_PARSE_SQL}), m -> map_keys(m)))),
                s -> concat(k, '[].', s)), array(k))
            ELSE array(k) END))"""
    )


def canonical(records: DataFrame) -> DataFrame:
    """The records with ``layout``, ``fingerprint`` and ``turns`` (null where no layout fits)."""
    known = F.array(*[F.lit(path) for path in _known_paths()])
    parsed = records.withColumn("_fields", F.from_json(RECORD, "map<string,string>", _PARSE))
    parsed = parsed.withColumn("fingerprint", fingerprint(F.array_intersect(field_paths(), known)))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for known_layout in LAYOUTS:
        same = F.col("fingerprint") == fingerprint(F.array(*[F.lit(p) for p in known_layout.paths]))
        layout = F.when(same, F.lit(known_layout.name)).otherwise(layout)
        turns = F.when(same, F.expr(known_layout.turns)).otherwise(turns)
    return parsed.withColumn("layout", layout).withColumn("turns", _clean(turns)).drop("_fields")


def _clean(turns: Column) -> Column:
    """Turns under canonical roles, nulls empty."""
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.transform(
        turns,
        lambda t: F.struct(
            F.coalesce(names[t["role"]], t["role"], F.lit("")).alias("role"),
            F.coalesce(t["text"], F.lit("")).alias("text"),
        ),
    )


def canonical_columns(records: DataFrame) -> DataFrame:
    """``canonical`` for records whose fields are columns, not JSON text: lists of messages as arrays of
    structs. The field paths are those of the schema."""
    paths = [
        f"{f.name}[].{sub.name}" if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType) else f.name
        for f in records.schema.fields
        for sub in (f.dataType.elementType.fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType) else [f])
    ]
    known = sorted(set(paths) & set(_known_paths()))
    layout = next((x for x in LAYOUTS if x.listed and sorted(x.paths) == known), None)
    if layout is None:
        turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    else:
        key, role, text = layout.listed
        turns = F.transform(key, lambda m: F.struct(m[role].alias("role"), m[text].alias("text")))
    return (
        records.withColumn("fingerprint", fingerprint(F.array(*[F.lit(p) for p in known]).cast("array<string>")))
        .withColumn("layout", F.lit(layout.name if layout else None).cast("string"))
        .withColumn("turns", _clean(turns))
    )


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\" + CONTROL, "$1")


def formatted(records: DataFrame) -> DataFrame:
    """Records given as JSON text, formatted."""
    return templated(canonical(records))


def templated(records: DataFrame) -> DataFrame:
    """Canonical records with ``formatted`` and ``loss_mask``: per turn its length, and where in it
    how many code points of assistant text stand."""
    heads = F.transform("turns", lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)))
    bodies = F.transform("turns", lambda t: escape(t["text"]))
    ready = records.withColumn("_heads", heads).withColumn("_bodies", bodies)
    said = F.zip_with("_heads", "_bodies", lambda h, b: F.concat(h, b, F.lit(END)))
    spans = F.zip_with(
        "turns",
        F.zip_with("_heads", "_bodies", lambda h, b: F.struct(F.length(h).alias("h"), F.length(b).alias("b"))),
        lambda t, n: F.struct(
            (n["h"] + n["b"] + len(END)).alias("turn_chars"),
            n["h"].alias("loss_from"),
            F.when(t["role"] == "assistant", n["b"]).otherwise(0).alias("loss_chars"),
        ),
    )
    return (
        ready.withColumn("formatted", F.concat(F.lit(BEGIN), F.array_join(said, "")))
        .withColumn("loss_mask", spans)
        .drop("_heads", "_bodies")
    )


def read_back(done: DataFrame) -> DataFrame:
    """``read_turns`` and ``loss_text``, taken from ``formatted`` and ``loss_mask`` alone."""
    # Inside a turn every control string has a backslash, so the plain ones part the turns. What
    # follows the last one is empty.
    pieces = F.split(F.substr("formatted", F.lit(len(BEGIN) + 1)), r" </s>\n")
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    head = F.length(F.lit(TURN))

    read = F.transform(
        turns,
        lambda p: F.struct(
            unescape(F.substr(F.substring_index(p, TEXT, 1), head + 1)).alias("role"),
            unescape(F.substr(p, F.length(F.substring_index(p, TEXT, 1)) + len(TEXT) + 1)).alias("text"),
        ),
    )
    masked = F.zip_with(
        turns, "loss_mask", lambda p, m: unescape(F.substr(p, m["loss_from"] + 1, m["loss_chars"]))
    )
    return done.withColumn("read_turns", read).withColumn("loss_text", F.array_join(masked, ""))


def records_from_rows(rows: DataFrame) -> DataFrame:
    """One message record per conversation (conv_id, record), as JSON text."""
    return messages_from_rows(rows).select("conv_id", F.to_json(F.struct("messages")).alias(RECORD))


def messages_from_rows(rows: DataFrame) -> DataFrame:
    """One message record per conversation (conv_id, messages) from a table with a row per turn, as
    columns: no text passes through a parser."""
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("content"),
    )
    messages = F.transform(
        F.sort_array(F.collect_list(turn)),
        lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")),
    )
    return rows.groupBy("conv_id").agg(messages.alias("messages"))


def digests(rows: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """Format conversations given as rows, and records of other layouts (conv_id, record), and
    summarise what is read back from the result."""
    columns = ("conv_id", "layout", "fingerprint", "turns")
    records = canonical_columns(messages_from_rows(rows)).select(*columns)
    if more is not None:
        records = records.unionByName(canonical(more).select(*columns))
    back = read_back(templated(records))
    spoken = F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("read_turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
