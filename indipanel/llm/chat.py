"""Chat formatting: fingerprints of nested field paths choose the mapping to canonical turns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The markers of the template. A formatted conversation is, turn after turn,
# <|turn|>role<|text|>text<|end|>
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"

# Strings that control a chat model in this or in other common templates.
CONTROL = ["|turn|>", "|text|>", "|end|>", "|im_start|>", "|im_end|>", "|endoftext|>", "s>", "/s>",
           "INST]", "/INST]"]


@dataclass(frozen=True)
class Layout:
    """One way in which conversations are stored, and how its turns are found.

    paths  field paths that it has, of all paths that any layout knows; [] is any element of an array
    before, after  turns from single fields: (role, paths whose texts are joined by a newline), one after the other
    arrays  between them: (path of an array of turns, paths of role and text below its elements)
    """

    name: str
    paths: tuple[str, ...]
    before: tuple[tuple[str, tuple[str, ...]], ...] = ()
    arrays: tuple[tuple[str, str, str], ...] = ()
    after: tuple[tuple[str, tuple[str, ...]], ...] = ()


def single(name: str, **fields: tuple[str, ...] | str) -> Layout:
    """A layout of one exchange: each keyword is a role with its field or fields."""
    turns = tuple((role, (f,) if isinstance(f, str) else f) for role, f in fields.items())
    return Layout(name, tuple(f for _, fs in turns for f in fs), before=turns)


def listed(name: str, *arrays: tuple[str, str, str], system: bool = False, answer: str = "") -> Layout:
    """A layout of arrays of turns, maybe behind a system text or before an answer in a field of its own."""
    paths = tuple(f"{a}[].{f}" for a, *below in arrays for f in below)
    return Layout(name, (*(("system",) if system else ()), *paths, *((answer,) if answer else ())),
                  before=(("system", ("system",)),) if system else (), arrays=arrays,
                  after=(("assistant", (answer,)),) if answer else ())


LAYOUTS = (
    listed("messages", ("messages", "role", "content")),
    listed("system_messages", ("messages", "role", "content"), system=True),
    listed("from_value", ("conversations", "from", "value")),
    listed("system_from_value", ("conversations", "from", "value"), system=True),
    listed("prompt_messages_completion", ("prompt", "role", "content"), answer="completion"),
    listed("prompt_messages_response", ("prompt", "role", "content"), answer="response"),
    listed("prompt_completion_messages", ("prompt", "role", "content"), ("completion", "role", "content")),
    single("instruction", user="instruction", assistant="output"),
    single("instruction_input", user=("instruction", "input"), assistant="output"),
    single("system_instruction", system="system", user="instruction", assistant="output"),
    single("system_instruction_input", system="system", user=("instruction", "input"), assistant="output"),
    single("prompt_completion", user="prompt", assistant="completion"),
    single("system_prompt_completion", system="system", user="prompt", assistant="completion"),
    single("prompt_response", user="prompt", assistant="response"),
    single("system_prompt_response", system="system", user="prompt", assistant="response"),
    single("question_answer", user="question", assistant="answer"),
    Layout("rows", ("conv_id", "turn", "role", "text")),
)

# The names that a role goes by in any layout; other roles stay as they are.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

_TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """The paths of all leaf fields below a type."""
    if isinstance(kind, T.StructType):
        return [p for f in kind for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


def text_paths(paths: list[str], known: list[str]) -> set[str]:
    """Paths of a schema, where a list of texts or of objects with a text counts as the known path that holds it."""
    def holder(path: str) -> str:
        return next((k for k in known if path == f"{k}[]" or (path.startswith(f"{k}[].") and path not in known)), path)
    return {holder(p) for p in paths}


def fingerprint(present: list[Column], paths: list[str]) -> Column:
    """Hash of those paths that are present, in their order."""
    return F.xxhash64(F.concat_ws("\n", *[F.when(p, F.lit(name)) for p, name in zip(present, paths)]))


def _known(layouts: tuple[Layout, ...]) -> list[str]:
    return sorted({p for x in layouts for p in x.paths})


def _of_layout(layout: Layout, known: list[str]) -> Column:
    return fingerprint([F.lit(p in layout.paths) for p in known], known)


def _role(role: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, role), role, F.lit(""))


def _is(value: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith(kind), F.lit(False))


def _elements(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _part(part: Column) -> Column:
    """Text of a part of a list: a string, or an object's field ``text``; NULL for any other part."""
    return F.when(_is(part, "STRING"), F.try_variant_get(part, "$", "string")).when(
        _is(F.try_variant_get(part, "$.text", "variant"), "STRING"), F.try_variant_get(part, "$.text", "string"))


def _readable(value: Column) -> Column:
    """Whether all of a value is text: null, a string, number or truth value, or a list of parts with a text each."""
    return F.when(_is(value, "ARRAY"), F.forall(_elements(value), lambda p: _part(p).isNotNull())).otherwise(~_is(value, "OBJECT"))


def _text(value: Column) -> Column:
    """The text of a readable value; texts of a list are joined by newlines, null is empty."""
    return F.coalesce(F.when(_is(value, "ARRAY"), F.array_join(F.transform(_elements(value), _part), "\n"))
                      .otherwise(F.try_variant_get(value, "$", "string")), F.lit(""))


def _mark(name: str, value: Column) -> Column:
    """The path if the value is there and readable, the path and ! if it is something else, NULL if it is missing."""
    return F.when(value.isNull(), None).when(_readable(value), F.lit(name)).otherwise(F.lit(name + "!"))


def _field(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, "$." + path, "variant")


def _marks(doc: Column, path: str, known: list[str]) -> Column:
    """What the fingerprint says about a path: nothing if it is missing, else the path, with a sign if not all of it is as layouts expect."""
    if "[]." not in path:
        value = _field(doc, path)
        below = any(p.startswith(path + "[].") for p in known)
        turns = F.exists(_elements(value), lambda m: _is(m, "OBJECT") & _part(m).isNull()) if below else F.lit(False)
        return F.when(_is(value, "ARRAY") & F.coalesce(turns, F.lit(False)), None).otherwise(_mark(path, value))
    array, below = path.split("[].")
    each = F.transform(_elements(_field(doc, array)), lambda m: F.coalesce(_mark(path, _field(m, below)), F.lit("")))
    # One element that has no such field, or holds something else there, tells the record from every layout.
    return F.when(F.exists(each, lambda x: x != ""), F.when(F.forall(each, lambda x: x == path), F.lit(path)).otherwise(F.lit(path + "!")))


def _readers(doc: Column, layouts: tuple[Layout, ...]) -> tuple[dict[str, Column], dict[tuple[str, str, str], Column]]:
    """The text of each field and the turns of each array that a layout names; every one is built once for all layouts."""
    fields = {p for x in layouts for _, paths in (*x.before, *x.after) for p in paths}
    texts = {p: _text(_field(doc, p)) for p in sorted(fields)}

    def turns(array: str, role: str, text: str) -> Column:
        return F.transform(_elements(_field(doc, array)), lambda m: F.struct(
            _role(_text(_field(m, role))).alias("role"), _text(_field(m, text)).alias("text")))

    return texts, {a: turns(*a) for a in sorted({a for x in layouts for a in x.arrays})}


def _turns_of(layout: Layout, texts: dict[str, Column], arrays: dict[tuple[str, str, str], Column]) -> Column:
    def from_fields(turns):
        return F.array(*[F.struct(F.lit(role).alias("role"), F.concat_ws("\n", *[
            F.nullif(texts[p], F.lit("")) for p in paths]).alias("text")) for role, paths in turns])

    parts = [*([from_fields(layout.before)] if layout.before else []), *[arrays[a] for a in layout.arrays],
             *([from_fields(layout.after)] if layout.after else [])]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def canonical_records(records: DataFrame, record: str = "record", conv_id: str = "conv_id",
                      layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """conv_id, layout, turns of records given as JSON texts, each in a layout of its own.

    The paths of a record that some layout knows are hashed; the layout with this
    fingerprint says where its turns are. A path below an array counts over all of its elements. Other fields do not count.
    A null text is empty; a list of texts, or of objects with a ``text``, is joined by newlines.

    No text is lost in silence: a record that is no JSON, whose elements disagree about their fields, that holds an object or
    a part without text where a text belongs, or whose fingerprint no layout has, keeps its row with layout and
    turns NULL. An empty array shows no nested path and so has no layout either. A conversation is one row, and its memory
    that of one record.
    """
    layouts = tuple(x for x in layouts if x.name != "rows")
    known = _known(layouts)
    here = records.select(F.col(conv_id).alias("conv_id"), F.try_parse_json(F.col(record)).alias("_doc"))
    doc = F.col("_doc")
    here = here.withColumn("_print", F.xxhash64(F.concat_ws("\n", *[_marks(doc, p, known) for p in known])))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    texts, arrays = _readers(doc, layouts)
    for x in layouts:
        hit = F.col("_print") == _of_layout(x, known)
        name, turns = F.when(hit, F.lit(x.name)).otherwise(name), F.when(hit, _turns_of(x, texts, arrays)).otherwise(turns)
    return here.select("conv_id", name.alias("layout"), turns.alias("turns"))


def canonical(df: DataFrame, conv_id: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """conv_id, layout, turns (array of role and text) of a table with one layout for all rows.

    The paths of the table's own schema give the fingerprint; columns that no layout knows are
    left aside. Raises ValueError if no layout has it. Layout ``rows`` holds a turn per row:
    turns go by their number, null first, then role, then text; rows that are equal in all
    three stay. A null role or text is empty. A row without id belongs to the conversation with
    id NULL. All other layouts hold a conversation per row. A conversation is gathered in one row, however many turns it has.
    """
    spark = df.sparkSession
    layout = None
    # The id is no part of the other layouts, so they are told apart without the paths of ``rows``.
    for some in ([x for x in layouts if x.name == "rows"], [x for x in layouts if x.name != "rows"]):
        known = _known(tuple(some))
        own = text_paths(schema_paths(df.schema), known)
        prints = spark.range(1).select(
            fingerprint([F.lit(p in own) for p in known], known).alias("own"),
            *[_of_layout(x, known).alias(x.name) for x in some]).first()
        layout = layout or next((x for x in some if prints[x.name] == prints["own"]), None)
    if layout is None:
        raise ValueError(f"no layout has the field paths {schema_paths(df.schema)}")
    if layout.name != "rows":
        return canonical_records(df.select(F.col(conv_id), F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
                                           .alias("_record")), "_record", conv_id, layouts)
    turn = F.struct(F.col("turn"), _role(F.col("role").cast("string")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = df.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    return rows.select("conv_id", F.lit("rows").alias("layout"), F.transform(
        "_turns", lambda m: F.struct(m.getField("role").alias("role"), m.getField("text").alias("text"))).alias("turns"))


def _control() -> str:
    rest = "|".join(x.replace("|", r"\|").replace("]", r"\]") for x in CONTROL)
    return rf"([<\[])(\\*)((?:{rest}))"


def escape(text: Column) -> Column:
    """A backslash after the first character of each control string.

    Control strings that already hold backslashes there get one more, so that every text
    can be told from every other and no control string is left in the result.
    """
    return F.regexp_replace(text, _control(), r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """Takes back ``escape``."""
    return F.regexp_replace(text, _control().replace(r"(\\*)", r"\\(\\*)"), "$1$2$3")


def format_turns(df: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, layout, formatted, loss_spans: canonical turns in the template's one string.

    loss_spans  start and end, in code points of ``formatted``, of the texts to be learned. A
    conversation without turns is the empty string; one without a layout stays NULL.
    """
    parts = df.withColumn("_parts", F.transform("turns", lambda m: F.struct(
        F.concat(F.lit(TURN), escape(m.getField("role")), F.lit(TEXT)).alias("head"),
        escape(m.getField("text")).alias("text"),
        m.getField("role").isin(*loss_roles).alias("loss"))))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(done, part):
        start = done.getField("at") + F.length(part.getField("head"))
        end = start + F.length(part.getField("text"))
        span = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))
        return F.struct(
            (end + len(END)).alias("at"),
            F.when(part.getField("loss"), F.concat(done.getField("spans"), F.array(span)))
            .otherwise(done.getField("spans")).alias("spans"))

    formatted = F.array_join(F.transform("_parts", lambda p: F.concat(
        p.getField("head"), p.getField("text"), F.lit(END))), "")
    return parts.select("conv_id", "layout", formatted.alias("formatted"),
                        F.aggregate("_parts", begin, add).getField("spans").alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns back from a formatted conversation."""
    pieces = F.split(formatted, TURN.replace("|", r"\|"))
    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda piece: F.struct(
        unescape(F.substring_index(piece, TEXT, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(piece, TEXT, -1), END, 1)).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped texts below the loss mask, in their order."""
    return F.transform(spans, lambda s: unescape(F.substring(
        formatted, s.getField("start") + 1, s.getField("end") - s.getField("start"))))


def format_chat(df: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """Conversations of any known layout in the template; columns as in ``format_turns``."""
    return format_turns(canonical(df, conv_id))
