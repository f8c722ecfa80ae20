"""Chat formatting by schema fingerprints, with DataFrame functions only.

Records have any layout: a variant, or a struct whose absent fields are null, as a scan of JSON files gives. The nested
field paths that a record holds, sorted and joined, are hashed to a fingerprint; a declarative mapping for that
fingerprint converts the record to turns (role, text). Mappings cover flat prompt and completion pairs, instruction
layouts with and without input, and message lists under several names; more can be passed in. Records without a
mapping have no turns and keep their fingerprint, for review.

Template, per turn: `<|im_start|>role\\ntext<|im_end|>\\n`. Inside roles and texts every `<`, any number of
backslashes and `|` gets one backslash more before the `|`, so that no control string can occur there and the
change can be undone; in roles `%` and line breaks are written as `%25` and `%0A` besides. The loss mask covers the
texts of assistant turns, as ranges of code points of the formatted string.

Null texts are empty, null roles are empty. Turns are ordered by turn number (nulls first), then role, then text; rows
repeated are turns repeated. A conversation is one output row, as its format is one string, so it has to stay under the
2 GB of a Spark string; a variant holds 128 MB, so tables of turns are gathered as structs. Rows with a null
conversation id form a conversation of their own, and rows of conversation -1 join the added one. Other columns are not
read. A conversation's time grows with its length, but for sorting its turns and adding up their lengths (n log n).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
START, END = "<|im_start|>", "<|im_end|>"
_TURNS = "array<struct<role:string,text:string>>"
#: Code points of a block in which a range of the formatted string is looked up.
BLOCK = 1024


@dataclass(frozen=True)
class Mapping:
    """A layout: single fields by role, those of one role joined by an empty line; or a list of messages with the names of its fields."""

    singles: tuple[tuple[str, tuple[str, ...]], ...] = ()
    messages: tuple[str, str, str] | None = None
    others: tuple[str, ...] = ()
    names: dict[str, str] = field(default_factory=dict)

    @property
    def paths(self) -> tuple[str, ...]:
        if self.messages:
            at, role, text = self.messages
            return tuple(f"$.{at}[].{f}" for f in (role, text, *self.others))
        return tuple(f"$.{f}" for _, fields in self.singles for f in fields)

    @property
    def key(self) -> str:
        return "\n".join(sorted(self.paths))

    def turns(self, single: Callable[[str], Column], messages: Callable[[str, str, str], Column]) -> Column:
        """Turns by functions that read a field, and a list of messages (r, t)."""
        if self.messages:
            known = F.create_map(*[F.lit(x) for pair in self.names.items() for x in pair]) if self.names else None
            role = lambda r: F.coalesce(known[r], r) if known is not None else r
            return F.transform(messages(*self.messages), lambda m: F.struct(role(m["r"]).alias("role"), m["t"].alias("text"))).cast(_TURNS)
        parts = [(role, F.concat_ws("\n\n", *[F.nullif(single(f), F.lit("")) for f in fields]) if len(fields) > 1 else single(fields[0])) for role, fields in self.singles]
        return F.array(*[F.struct(F.lit(role).alias("role"), text.alias("text")) for role, text in parts]).cast(_TURNS)


def flat(*turns: tuple[str, str]) -> Mapping:
    """A layout of single fields: (role, field) in order."""
    return Mapping(singles=tuple((role, (f,)) for role, f in turns))


def listed(at: str, role: str, text: str, *others: str, names: dict[str, str] | None = None) -> Mapping:
    """A layout with a list of messages under `at`; names: roles to rename."""
    return Mapping(messages=(at, role, text), others=others, names=names or {})


SHARED = {"human": "user", "gpt": "assistant", "bot": "assistant"}
MAPPINGS = (
    flat(("user", "prompt"), ("assistant", "completion")),
    flat(("user", "prompt"), ("assistant", "response")),
    flat(("user", "question"), ("assistant", "answer")),
    flat(("system", "system"), ("user", "prompt"), ("assistant", "response")),
    flat(("user", "instruction"), ("assistant", "output")),
    Mapping(singles=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    listed("messages", "role", "content"),
    listed("conversations", "from", "value", names=SHARED),
    listed("turns", "role", "text"),
    listed("turns", "role", "text", "turn"),
)


def variant_paths(record: Column) -> Column:
    """The nested field paths of a variant, from its schema: `$.a.b` for fields, `[]` for lists, in order."""
    # The schema reads OBJECT<a: ARRAY<OBJECT<b: STRING>>, c: STRING>. Names of open objects stack up.
    schema = F.schema_of_variant(record)
    steps = F.regexp_extract_all(schema, F.lit(r"(OBJECT<|ARRAY<|>|(?:`(?:[^`]|``)*`|[^\s:<>,]+): |, |[A-Z0-9(),]+)"), 1)
    start = F.struct(F.array(F.lit("$")).alias("stack"), F.lit("$").alias("at"), F.array().cast("array<string>").alias("found")).cast("struct<stack:array<string>,at:string,found:array<string>>")

    def step(s: Column, t: Column) -> Column:
        def to(stack: Column, at: Column, found: Column) -> Column:
            return F.struct(stack.alias("stack"), at.alias("at"), found.alias("found"))

        top = F.element_at(s["stack"], -1)
        name = F.concat(top, F.lit("."), F.regexp_replace(t, "`|: $", ""))
        return (
            F.when(t == "OBJECT<", to(F.concat(s["stack"], F.array(s["at"])), s["at"], s["found"]))
            .when(t == "ARRAY<", to(F.concat(s["stack"], F.array(F.concat(s["at"], F.lit("[]")))), F.concat(s["at"], F.lit("[]")), s["found"]))
            .when(t == ">", to(F.slice(s["stack"], 1, F.size(s["stack"]) - 1), s["at"], s["found"]))
            .when(t.endswith(": "), to(s["stack"], name, s["found"]))
            .when(t.startswith(","), s)
            .otherwise(to(s["stack"], s["at"], F.concat(s["found"], F.array(s["at"]))))
        )

    return F.array_sort(F.array_distinct(F.aggregate(steps, start, step)["found"]))


def leaves(kind: T.DataType) -> list[tuple[str, Callable[[Column], Column]]]:
    """The path below a value of this type to each of its leaves, and whether a value holds one that isn't null."""
    if isinstance(kind, T.StructType):
        return [(f".{f.name}{path}", lambda v, f=f, held=held: held(v.getField(f.name))) for f in kind.fields for path, held in leaves(f.dataType)]
    if isinstance(kind, T.ArrayType):
        return [(f"[]{path}", lambda v, held=held: F.exists(v, lambda x: held(x))) for path, held in leaves(kind.elementType)]
    return [("", lambda v: v.isNotNull())]


def paths(record: Column, kind: T.DataType) -> Column:
    """The nested field paths that a record of this type holds, in order."""
    if isinstance(kind, T.VariantType):
        return variant_paths(record)
    return F.array_sort(F.array_compact(F.array(*[F.when(held(record), f"${path}") for path, held in leaves(kind)])))


def fingerprint(record: Column, kind: T.DataType) -> Column:
    return F.xxhash64(F.array_join(paths(record, kind), "\n"))


def _readers(kind: T.DataType) -> tuple[Callable[[str], Column], Callable[[str, str, str], Column]]:
    """How single fields and messages are read from the column `record`."""
    if isinstance(kind, T.VariantType):

        def messages(at: str, role: str, text: str) -> Column:
            found = F.try_variant_get("record", f"$.{at}", f"array<struct<`{role}`:string,`{text}`:string>>")
            return F.transform(found, lambda m: F.struct(m[role].alias("r"), m[text].alias("t")))

        return lambda f: F.try_variant_get("record", f"$.{f}", "string"), messages

    def typed(at: str, role: str, text: str) -> Column:
        return F.transform(F.col("record").getField(at), lambda m: F.struct(m.getField(role).cast("string").alias("r"), m.getField(text).cast("string").alias("t")))

    return lambda f: F.col("record").getField(f).cast("string"), typed


def turns(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """records (record: variant or struct, and others) with `fingerprint` and `turns`; no mapping: null turns."""
    kind = records.schema["record"].dataType
    known = records.withColumn("fingerprint", fingerprint(F.col("record"), kind))
    held = None if isinstance(kind, T.VariantType) else {f"${path}" for path, _ in leaves(kind)}
    made = F.lit(None).cast(_TURNS)
    for m in mappings:
        if held is None or held.issuperset(m.paths):  # others can't occur
            made = F.when(F.col("fingerprint") == F.xxhash64(F.lit(m.key)), m.turns(*_readers(kind))).otherwise(made)
    return known.withColumn("turns", made)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """Also without line breaks: `%` becomes `%25` and a line break `%0A`."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def formatted(own: Column) -> Column:
    """The template over turns (role, text)."""
    return F.array_join(
        F.transform(own, lambda t: F.concat(F.lit(START), escape_role(F.coalesce(t["role"], F.lit(""))), F.lit("\n"), escape(F.coalesce(t["text"], F.lit(""))), F.lit(END + "\n"))), ""
    )


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value evaluated once for a row even where it is used within lambdas."""
    return F.get(F.transform(F.array(value), then), 0)


def running(values: Column) -> Column:
    """Running sums of an array of longs, in rounds that double their reach: n log n steps, where a fold that appends takes n * n."""
    def sums(v: Column) -> Column:
        reach = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda d: d < F.size(v))
        return F.aggregate(reach, v, lambda s, d: F.transform(s, lambda x, i: x + F.when(i >= d, F.get(s, i - d)).otherwise(F.lit(0).cast("long"))))

    return let(values, sums)


def loss_ranges(own: Column) -> Column:
    """(start, stop) code points of the assistants' texts in the formatted string."""
    tail = len(END) + 1

    def sizes(t: Column) -> Column:
        role, text = escape_role(F.coalesce(t["role"], F.lit(""))), escape(F.coalesce(t["text"], F.lit("")))
        return F.struct((len(START) + F.length(role) + 1 + F.length(text) + tail).cast("long").alias("all"), F.length(text).cast("long").alias("text"), F.coalesce(t["role"] == "assistant", F.lit(False)).alias("spoken"))

    def ranges(each: Column) -> Column:
        ends = running(F.transform(each, lambda x: x["all"]))
        of = lambda e: F.transform(each, lambda x, i: F.when(x["spoken"], F.struct((F.get(e, i) - tail - x["text"]).alias("start"), (F.get(e, i) - tail).alias("stop"))))
        return F.array_compact(let(ends, of))

    return let(F.transform(own, sizes), ranges)


def masked(text: Column, ranges: Column, then: Callable[[Column], Column]) -> Column:
    """then() of the text in each range of code points, joined. The text is cut into blocks once, and a range reads its own blocks only."""
    def cut(blocks: Column, r: Column) -> Column:
        first, last = F.floor(r["start"] / BLOCK), F.floor(r["stop"] / BLOCK)
        near = F.array_join(F.transform(F.sequence(first, last), lambda i: F.coalesce(F.get(blocks, i.cast("int")), F.lit(""))), "")
        return then(F.substring(near, (r["start"] - first * BLOCK + 1).cast("int"), (r["stop"] - r["start"]).cast("int")))

    return F.array_join(let(F.regexp_extract_all(text, F.lit(f"(?s)(.{{1,{BLOCK}}})"), 1), lambda blocks: F.transform(ranges, lambda r: cut(blocks, r))), "")


def read_back(text: Column) -> Column:
    """Turns (role, text) of a formatted string."""
    pieces = F.split(text, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    inner = F.transform(pieces, lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))
    return F.transform(
        inner,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substring(p, F.instr(p, "\n") + 1, F.length(p))).alias("text"),
        ),
    )


def gathered(conversations: DataFrame) -> DataFrame:
    """(conv_id, record): the rows of each conversation as one struct, in order of turns."""
    row = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    own = F.array_sort(F.collect_list(row))
    plain = F.transform(own, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return conversations.groupBy("conv_id").agg(F.struct(plain.alias("turns")).alias("record"))


def chat(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """records with `fingerprint`, `formatted` and `loss` (code point ranges); records without a mapping: nulls."""
    return turns(records, mappings).withColumn("formatted", formatted(F.col("turns"))).withColumn("loss", loss_ranges(F.col("turns"))).drop("turns")


#: Conversation -1 of the contract.
EXTRA = f"{END}{START}assistant ok"


def report(conversations: DataFrame) -> DataFrame:
    """Counts and digests read back from the formatted conversations, with conversation -1 added."""
    spark = conversations.sparkSession
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA).alias("text")
    )
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(extra)
    made = chat(gathered(rows)).withColumn("back", read_back(F.col("formatted")))
    spoken = masked(F.col("formatted"), F.col("loss"), unescape)
    all_turns = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(all_turns, 256).alias("turns_sha256"),
        F.length(spoken).cast("long").alias("loss_chars"),
        F.sha2(spoken, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
with extra as (
  select * from (values (-1::bigint, 0::bigint, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')) t(conv_id, turn, role, text)),
rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all by name select * from extra),
marked as (
  select *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') as escaped,
    regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\1\\|', 'g') as marked_role from rows)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(12 + length(marked_role) + 1 + length(escaped) + 11)::bigint as formatted_chars
from marked group by conv_id"""
