r"""Operator 5: chat formatting by schema fingerprinting.

Records of conversations come as JSON in many layouts. A record's schema fingerprint is
the MD5 of its sorted nested field paths (``messages``, ``messages[].role``, ...), as far
as they occur in any known layout, so that further fields don't matter. The fingerprint
selects a declarative mapping to canonical turns (role, text), and one template writes
the turns and marks which code points count for the loss.

Template, per turn::

    ### Role:\n<escaped text></turn>\n

Inside roles and texts a backslash becomes ``\b``, ``###`` becomes ``\h`` and ``</turn>``
becomes ``\t``; inside roles a line break becomes ``\n``. Every backslash of escaped text
so begins one of these codes, and undoing them, ``\b`` last, gives back the text whatever
it was.

Defined cases: null text or role is the empty string; turns are ordered by turn number
(nulls first), then role and text, and repeated turns stay; a record of no known layout,
or null or broken JSON, has layout ``unknown`` and no turns; of a field that a record has
twice the first counts; an empty conversation is the empty string; only roles that are
exactly ``assistant`` count for the loss. A layout is judged by the first element of its
array. Texts may be as long as a cell: the JSON parser's own limit on strings is lifted. A
conversation is one row, so all its turns together must fit into a cell of 2 GB; a longer
one fails the job rather than being cut. Columns of the input keep their values: an output
whose name is taken gets underscores behind it.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, table

END = "</turn>\n"
LOSS_ROLE = "assistant"
#: The parser refuses strings of more than 20 million characters if it isn't told otherwise.
WHOLE = {"maxStringLen": str((1 << 31) - 1)}
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """A declarative mapping to turns: either a list of elements (``listed``: the field, and its
    elements' role, text and, if any, order), or a pair of questions and an answer. ``roles``:
    names of roles in this layout and what they are called here."""

    name: str
    listed: tuple[str, ...] = ()
    asked: tuple[str, ...] = ()
    answer: str = ""
    roles: dict = field(default_factory=dict, hash=False)

    @property
    def paths(self) -> tuple[str, ...]:
        """The field paths that a record of this layout has."""
        if self.listed:
            name, *inner = self.listed
            return (name, *(f"{name}[].{x}" for x in inner))
        return (*self.asked, self.answer)

    @property
    def fingerprint(self) -> str:
        return hashlib.md5(",".join(sorted(self.paths)).encode()).hexdigest()


OTHER_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout("turns", listed=("turns", "role", "text", "turn")),
    Layout("messages", listed=("messages", "role", "content")),
    Layout("conversations", listed=("conversations", "from", "value"), roles=OTHER_NAMES),
    Layout("dialog", listed=("dialog", "speaker", "utterance"), roles=OTHER_NAMES),
    Layout("instruction_input", asked=("instruction", "input"), answer="output"),
    Layout("instruction", asked=("instruction",), answer="output"),
    Layout("prompt_completion", asked=("prompt",), answer="completion"),
    Layout("prompt_response", asked=("prompt",), answer="response"),
    Layout("question_answer", asked=("question",), answer="answer"),
)


def _list_fields(layouts: tuple[Layout, ...]) -> list[str]:
    return [x.listed[0] for x in layouts if x.listed]


def parsed(df: DataFrame, record: str, fields: str, elements: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``fields``, a record's top fields, and ``elements``, those of its list (JSON as maps)."""
    found = df.withColumn(fields, F.from_json(F.col(record), "map<string,string>", WHOLE))
    listed = F.coalesce(*(F.try_element_at(F.col(fields), F.lit(f)) for f in _list_fields(layouts)), F.lit(None).cast("string"))
    return found.withColumn(elements, F.from_json(listed, "array<map<string,string>>", WHOLE))


def schema_fingerprint(fields: Column, elements: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """MD5 of the sorted field paths of a parsed record that belong to any of ``layouts``."""
    known = F.array(*(F.lit(p) for p in sorted({p for x in layouts for p in x.paths})))
    none = F.array().cast("array<string>")
    tops = F.coalesce(F.map_keys(fields), none)
    inner = F.coalesce(F.map_keys(F.get(elements, F.lit(0))), none)
    lists = F.array(*(F.lit(f) for f in _list_fields(layouts)))
    held = F.filter(lists, lambda f: F.array_contains(tops, f))
    nested = F.transform(inner, lambda k: F.concat(F.get(held, F.lit(0)), F.lit("[]."), k))
    return F.md5(F.array_join(F.array_sort(F.array_intersect(F.concat(tops, nested), known)), ","))


def _turns(layout: Layout, fields: Column, elements: Column) -> Column:
    """The turns (role, text) of a parsed record of this layout."""

    def of(entry: Column, name: str) -> Column:
        return F.try_element_at(entry, F.lit(name))

    if not layout.listed:
        asked = F.concat_ws("\n\n", *(F.nullif(of(fields, f), F.lit("")) for f in layout.asked))
        pair = F.array(F.struct(F.lit("user").alias("role"), asked.alias("text")), F.struct(F.lit("assistant").alias("role"), of(fields, layout.answer).alias("text")))
        return pair.cast(TURNS)
    _, role, text, *order = layout.listed
    if not order:
        return F.transform(elements, lambda x: F.struct(of(x, role).alias("role"), of(x, text).alias("text"))).cast(TURNS)
    placed = F.transform(elements, lambda x: F.struct(of(x, order[0]).try_cast("bigint").alias("o"), of(x, role).alias("role"), of(x, text).alias("text")))
    return F.transform(F.array_sort(placed), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).cast(TURNS)


def _canonical(layout: Layout):
    """A turn without nulls and with the usual name of its role."""
    names = F.create_map(*(F.lit(v) for pair in layout.roles.items() for v in pair)) if layout.roles else None

    def turn(t: Column) -> Column:
        role = F.coalesce(t["role"], F.lit(""))
        known = role if names is None else F.coalesce(F.try_element_at(names, role), role)
        return F.struct(known.alias("role"), F.coalesce(t["text"], F.lit("")).alias("text"))

    return turn


def canonical_turns(df: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``schema_fingerprint``, ``layout`` and ``turns`` (array of role, text)."""
    fields, elements, mark = (fresh(df, c) for c in ("__fields", "__elements", "schema_fingerprint"))
    found = parsed(df, record, fields, elements, layouts).withColumn(mark, schema_fingerprint(F.col(fields), F.col(elements), layouts))
    name, turns = F.lit("unknown"), F.lit(None).cast(TURNS)
    for x in layouts:
        here = _turns(x, F.col(fields), F.col(elements))
        hit = F.col(mark) == x.fingerprint
        name = F.when(hit, F.lit(x.name)).otherwise(name)
        turns = F.when(hit, F.transform(here, _canonical(x))).otherwise(turns)
    turns = F.coalesce(turns, F.array().cast(TURNS))
    return found.withColumns({fresh(df, "layout"): name, fresh(df, "turns"): turns}).drop(fields, elements)


def escape(text: Column) -> Column:
    for plain, code in (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in (("###", "\\h"), ("</turn>", "\\t"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def format_turns(df: DataFrame, turns: str = "turns") -> DataFrame:
    """Adds ``formatted``, and ``loss_mask``: (start, length) in code points, from 1."""

    def head(t: Column) -> Column:
        return F.concat(F.lit("### "), escape_role(t["role"]), F.lit(":\n"))

    parts = F.transform(F.col(turns), lambda t: F.struct(t["role"].alias("role"), head(t).alias("head"), escape(t["text"]).alias("body")))

    def add(done: Column, p: Column) -> Column:
        start = done["at"] + F.length(p["head"])
        size = F.length(p["body"])
        span = F.struct(start.cast("int").alias("start"), size.cast("int").alias("length"))
        spans = F.when(p["role"] == LOSS_ROLE, F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct((start + size + len(END)).cast("int").alias("at"), spans.alias("spans"))

    empty = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    held = fresh(df, "__parts")
    written = df.withColumn(held, parts)
    text = F.array_join(F.transform(held, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    mask = F.aggregate(held, empty, add)["spans"]
    return written.withColumns({fresh(df, "formatted"): text, fresh(df, "loss_mask"): mask}).drop(held)


def parse_formatted(df: DataFrame, formatted: str = "formatted") -> DataFrame:
    """Adds ``read_turns``, the turns as read back from the formatted text alone."""
    chunks = F.filter(F.split(F.col(formatted), END, -1), lambda c: c != "")

    def turn(c: Column) -> Column:
        cut = F.instr(c, ":\n")
        role = F.substring(c, F.lit(5), cut - 5)
        text = F.substring(c, cut + 2, F.length(c))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return df.withColumn(fresh(df, "read_turns"), F.transform(chunks, turn))


def records_of_turns(rows: DataFrame, key: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(key, ``record``): a JSON record per conversation from a table with a row per turn.

    Records are as heterogeneous as their sources would write them: each conversation is
    written in one of the layouts that can hold it exactly, dealt out by its key. Pairs hold a
    user and an assistant turn only; layouts with role names of their own hold no role that
    is read as another.
    """
    turn = F.struct(F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = rows.groupBy(key).agg(F.sort_array(F.collect_list(turn)).alias("__turns"))
    turns = F.col("__turns")
    roles = F.transform(turns, lambda t: t["role"])
    is_pair = roles == F.array(F.lit("user"), F.lit("assistant"))

    def written(x: Layout) -> tuple[Column, Column]:
        """Whether the layout can hold the conversation, and its record."""
        if x.answer:
            cells = [(turns[0]["text"] if i == 0 else F.lit("")).alias(f) for i, f in enumerate(x.asked)]
            return is_pair, F.struct(*cells, turns[1]["text"].alias(x.answer))
        name, role, text, *order = x.listed
        called = {v: k for k, v in reversed(x.roles.items())}
        names = F.create_map(*(F.lit(v) for pair in called.items() for v in pair)) if called else None

        def entry(t: Column) -> Column:
            own = t["role"] if names is None else F.coalesce(F.try_element_at(names, t["role"]), t["role"])
            return F.struct(own.alias(role), t["text"].alias(text), *(t["turn"].alias(o) for o in order))

        fits = ~F.exists(roles, lambda r: r.isin(*x.roles)) if x.roles else F.lit(True)
        return fits, F.struct(F.transform(turns, entry).alias(name))

    ways = [written(x) for x in layouts]
    fitting = F.filter(F.array(*(F.when(ok, F.lit(i)) for i, (ok, _) in enumerate(ways))), lambda i: i.isNotNull())
    chosen = grouped.withColumn("__way", F.get(fitting, F.pmod(F.xxhash64(key), F.size(fitting)).cast("int")))
    record = F.lit(None).cast("string")
    for i, (_, cells) in enumerate(ways):
        record = F.when(F.col("__way") == i, F.to_json(cells, {"ignoreNullFields": "false"})).otherwise(record)
    return chosen.select(key, record.alias("record"))


#: The conversation that the query adds.
EXTRA_TEXT = "\\### Assistant: </turn> ok"


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.inline(F.array(*(F.struct(F.lit(i).cast("bigint").alias("turn"), F.lit(r).alias("role"), F.lit(EXTRA_TEXT).alias("text")) for i, r in enumerate(("user", "assistant"))))),
    )
    records = records_of_turns(rows.unionByName(extra))
    done = parse_formatted(format_turns(canonical_turns(records)))
    under_mask = F.array_join(F.transform("loss_mask", lambda s: unescape(F.substring(F.col("formatted"), s["start"], s["length"]))), "")
    done = done.withColumn("__loss", under_mask)
    turns = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size("read_turns").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("__loss").cast("bigint").alias("loss_chars"),
        F.sha2("__loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


_ESC = r"replace(replace(replace({0}, '\', '\b'), '###', '\h'), '</turn>', '\t')"
OP5_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || replace({_ESC.format('role')}, chr(10), '\n') || ':' || chr(10) || {_ESC.format('text')} || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

QUERIES = {"op5_chat_formatting": op5_chat_formatting}
SQL = {"op5_chat_formatting": OP5_SQL}
