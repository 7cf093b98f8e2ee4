"""Chat records of many layouts as canonical turns, and turns as one marked string with a loss mask.

A layout is recognised by a fingerprint: the hash of its nested field paths, whatever the types of the values. For a
table the paths come from its schema, for JSON records from each record. The fingerprint selects a declarative mapping
to turns. The template marks turns with control strings and escapes them inside texts, so that formatting can be undone.
Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role string, text string>>"


@dataclass(frozen=True)
class Layout:
    """How one shape of record becomes turns.

    paths: the nested fields of the record, `[]` for the elements of an array. Either `items` names the array of turns
    with its role and text fields, or `fixed` lists turns of a role and the fields whose texts are joined by a newline,
    or `rows` names the turn, role and text of a table with one row per turn, whose roles stay as they are.
    """

    name: str
    paths: tuple[str, ...]
    items: tuple[str, str, str] | None = None
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    rows: tuple[str, str, str] | None = None

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


LAYOUTS = (
    Layout("messages", ("messages[].content", "messages[].role"), ("messages", "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"), ("conversations", "from", "value")),
    Layout("instruction", ("input", "instruction", "output"), fixed=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("short instruction", ("instruction", "output"), fixed=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("prompt", ("completion", "prompt"), fixed=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt and response", ("prompt", "response"), fixed=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("rows", ("role", "text", "turn"), rows=("turn", "role", "text")),
)
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}  # other roles stay as they are


def fingerprint(paths: tuple[str, ...]) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


def paths_of(schema: T.DataType, at: str = "") -> tuple[str, ...]:
    """The nested field paths of a schema."""
    if isinstance(schema, T.StructType):
        return tuple(p for f in schema for p in paths_of(f.dataType, f"{at}.{f.name}" if at else f.name))
    if isinstance(schema, T.ArrayType):
        return paths_of(schema.elementType, f"{at}[]")
    return (at,)


def record_fingerprint(record: Column) -> Column:
    """Fingerprint of a variant value: its shape as Spark prints it, with the types of plain values left out.

    Shapes are matched as printed text, so layouts print theirs the same way (see `_printed`). An empty array has no
    fields, so its record has a fingerprint of its own.
    """
    shape = F.regexp_replace(F.schema_of_variant(record), r": (?!ARRAY<|OBJECT<)[A-Z]+(\([0-9,]+\))?", "")
    return F.md5(shape)


def _printed(layout: Layout) -> str:
    """The shape of a layout as schema_of_variant prints it, without plain types."""
    if layout.items:
        array, *fields = layout.items
        return f"OBJECT<{array}: ARRAY<OBJECT<{', '.join(sorted(fields))}>>>"
    return f"OBJECT<{', '.join(sorted(layout.paths))}>"


def _mapped(layout: Layout, record: Column) -> Column:
    if layout.items:
        array, role, text = layout.items
        items = F.try_variant_get(record, f"$.{array}", f"array<struct<`{role}` string, `{text}` string>>")
        return F.transform(items, lambda x: F.struct(x[role].alias("role"), x[text].alias("text")))
    turns = []
    for role, fields in layout.fixed:
        parts = [F.try_variant_get(record, f"$.{name}", "string") for name in fields]
        joined = F.concat_ws("\n", *[F.when(p != "", p) for p in parts])
        turns.append(F.struct(F.lit(role).alias("role"), joined.alias("text")))
    return F.array(*turns)


def turns_of_records(records: DataFrame, conv_id: str, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, layout, turn, role, text): the turns of a column of JSON strings.

    A record that is null, no JSON or of no known layout gives one row with a null layout, turn, role and text, so that
    nothing is lost unseen. Null roles and texts become empty.
    """
    parsed = records.select(F.col(conv_id).alias("conv_id"), F.try_parse_json(record).alias("record"))
    parsed = parsed.withColumn("shape", record_fingerprint(F.col("record")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for one in (one for one in layouts if one.rows is None):
        same = F.col("shape") == hashlib.md5(_printed(one).encode()).hexdigest()
        layout = F.when(same, F.lit(one.name)).otherwise(layout)
        turns = F.when(same, _mapped(one, F.col("record"))).otherwise(turns)
    mapped = parsed.select("conv_id", layout.alias("layout"), turns.alias("turns"))
    rows = mapped.select("conv_id", "layout", F.posexplode_outer("turns").alias("turn", "one"))
    known = F.col("layout").isNotNull()
    role, text = (F.when(known, F.coalesce(F.col(f"one.{c}"), F.lit(""))) for c in ("role", "text"))
    return rows.select("conv_id", "layout", F.col("turn").cast("long").alias("turn"), _canonical(role).alias("role"), text.alias("text"))


def _canonical(role: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(F.element_at(names, role), role)


def turns_of_table(table: DataFrame, conv_id: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, turn, role, text): the turns of a table, by the mapping that its schema's fingerprint selects.

    A table of one row per turn keeps its roles and turns as they are. If the columns besides the key have no known
    fingerprint, the largest layout that they hold is taken and the others are left out; with none the table is refused. Null
    roles and texts are empty, a null array of turns gives no row, rows without a key share the null key, repeated rows stay. An
    empty table gives an empty result.
    """
    paths = tuple(p for p in paths_of(table.schema) if p != conv_id)
    known = {one.fingerprint: one for one in layouts}
    fitting = [one for one in layouts if set(one.paths) <= set(paths)]
    layout = known.get(fingerprint(paths)) or max(fitting, key=lambda one: len(one.paths), default=None)
    if layout is None:
        raise ValueError(f"no layout for the fields {sorted(paths)}")
    if layout.rows:
        turn, role, text = layout.rows
        columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))]
        return table.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), *columns)
    record = F.to_variant_object(F.struct(*sorted({p.split("[")[0].split(".")[0] for p in layout.paths})))
    rows = table.select(F.col(conv_id).alias("conv_id"), F.posexplode(_mapped(layout, record)).alias("turn", "one"))
    role, text = (F.coalesce(F.col(f"one.{c}"), F.lit("")) for c in ("role", "text"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), _canonical(role).alias("role"), text.alias("text"))


def escaped(text: Column) -> Column:
    """No control string is left: each begins with `<|`, which becomes `<\\|`; a backslash becomes two."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _unescaped_role(role: Column) -> Column:
    plain = F.transform(F.split(role, r"\\\\"), lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|")))
    return F.array_join(plain, "\\")


def format_turns(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss): one string per conversation, and the spans (start, length in characters, from 0) of
    the texts that are to be learned: those of the role `learn`.

    Turns are ordered by turn, then role and text; a null turn comes first. Null roles and texts are empty. Rows without
    a conv_id are one conversation. Other columns are ignored. An empty table gives an empty result.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(START), _escaped_role(role), F.lit("\n"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), head.alias("head"), escaped(text).alias("body"))
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    span = F.when(F.col("role") == learn, F.struct((before + F.length("head")).alias("start"), F.length("body").cast("long").alias("length")))
    placed = rows.select("conv_id", F.row_number().over(order).alias("place"), "piece", span.alias("span"))
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "piece", "span"))).alias("turns"))
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["span"].isNotNull()), lambda t: t["span"]).alias("loss"),
    )


def parse_formatted(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, learned, formatted_chars): the turns and the learned texts, read back from formatted strings."""
    marked = F.split("formatted", r"<\|im_end\|>\n", -1)
    pieces = F.transform(F.slice(marked, 1, F.size(marked) - 1), lambda p: F.substring(p, len(START) + 1, 2**31 - 1))
    head = lambda p: F.substring_index(p, "\n", 1)
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            _unescaped_role(head(p)).alias("role"),
            unescaped(F.substring(p, F.length(head(p)) + 2, F.length(p))).alias("text"),
        ),
    )
    learned = F.transform("loss", lambda s: unescaped(F.substring("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("conv_id", turns.alias("turns"), learned.alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"))
