"""Chat formatting: records of many layouts to canonical turns, and turns to
training text with a loss mask.

A record's layout is told by a fingerprint: the nested field paths of the record
that any layout knows, sorted and hashed. The fingerprint selects a declarative
mapping (:class:`Layout`), and the mapping's rules give the record's turns. A
record whose fingerprint no layout has is counted, never guessed.

The text form marks every turn, ``<|im_start|>role`` and ``<|im_end|>``. Inside
texts a ``<``, any number of backslashes and a ``|`` get one more backslash, so no
text can hold a mark, and taking one away restores it. The loss mask is a list
of runs in code points: ``skip`` characters without loss, then ``take`` with it;
there is one run a turn, so a reader needs no position from the start of the text.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from .common import small, stored

TURN = "struct<place:bigint,pos:int,role:string,text:string>"

# The marks of the text form.
START, END = "<|im_start|>", "<|im_end|>\n"

# Speakers of other layouts, by their canonical role.
SPEAKERS = {"human": "user", "user": "user", "prompter": "user", "gpt": "assistant", "assistant": "assistant",
            "bot": "assistant", "model": "assistant", "chatgpt": "assistant", "system": "system", "tool": "tool"}


@dataclass(frozen=True)
class One:
    """One turn: a fixed role, its text at ``path``. Left out where the path is
    absent or null, but for ``always``."""
    role: str
    path: str
    always: bool = False


@dataclass(frozen=True)
class Joined:
    """One turn of several paths' texts with a blank line between; those that are
    absent, null or empty are left out."""
    role: str
    paths: tuple[str, ...]


@dataclass(frozen=True)
class Each:
    """One turn per element of the list at ``path``. With ``speakers`` roles are
    made canonical; others, and null as the empty role, stay as they are."""
    path: str
    role: str
    text: str
    speakers: bool = False


@dataclass(frozen=True)
class Alternate:
    """One turn per text of the list at ``path``: user, assistant, user, ..."""
    path: str


@dataclass(frozen=True)
class Row:
    """The record is a turn itself; ``place`` orders the records of a conversation."""
    place: str
    role: str
    text: str


@dataclass(frozen=True)
class Layout:
    """``needs`` and ``may`` are field paths: ``a.b`` is b inside a, ``a[].b`` is b
    inside the elements of a, ``a[]`` a list of plain values or an empty one.
    Paths that no layout knows don't count."""
    name: str
    needs: tuple[str, ...]
    rules: tuple[One | Joined | Each | Alternate | Row, ...]
    may: tuple[str, ...] = ()


LAYOUTS = (
    Layout("rows", ("turn", "role", "text"), (Row("turn", "role", "text"),)),
    Layout("messages", ("messages[].role", "messages[].content"),
           (One("system", "system"), Each("messages", "role", "content")), ("system",)),
    Layout("messages in parts", ("messages[].role", "messages[].content[].text"),
           (One("system", "system"), Each("messages", "role", "content")), ("system", "messages[].content[].type")),
    Layout("list of messages", ("messages[]",), (Alternate("messages"),)),
    Layout("conversations", ("conversations[].from", "conversations[].value"),
           (One("system", "system"), Each("conversations", "from", "value", True)), ("system",)),
    Layout("list of conversations", ("conversations[]",), (Alternate("conversations"),)),
    Layout("instruction", ("instruction", "output"),
           (One("system", "system"), Joined("user", ("instruction", "input")), One("assistant", "output", True)),
           ("system", "input")),
    Layout("instruction, response", ("instruction", "response"),
           (One("system", "system"), Joined("user", ("instruction", "context")), One("assistant", "response", True)),
           ("system", "context")),
    Layout("prompt", ("prompt", "completion"),
           (One("system", "system"), One("user", "prompt", True), One("assistant", "completion", True)), ("system",)),
    Layout("prompt, response", ("prompt", "response"),
           (One("system", "system"), One("user", "prompt", True), One("assistant", "response", True)), ("system",)),
    Layout("lists of prompt and completion",
           ("prompt[].role", "prompt[].content", "completion[].role", "completion[].content"),
           (Each("prompt", "role", "content"), Each("completion", "role", "content"))),
    Layout("question", ("question", "answer"),
           (One("system", "system"), One("user", "question", True), One("assistant", "answer", True)), ("system",)),
    Layout("nested data", ("data.prompt", "data.completion"),
           (One("user", "data.prompt", True), One("assistant", "data.completion", True))),
)


def _print_of(paths) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


def fingerprints(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, str]:
    """Layout by fingerprint: one per layout and choice of its optional paths.
    Two layouts with one fingerprint raise."""
    out: dict[str, str] = {}
    for x in layouts:
        for n in range(len(x.may) + 1):
            for some in combinations(x.may, n):
                key = _print_of({*x.needs, *some})
                if out.setdefault(key, x.name) != x.name:
                    raise ValueError(f"layouts {out[key]!r} and {x.name!r} can't be told apart")
    return out


def field_paths(shape: Column) -> Column:
    """Nested field paths of a shape as ``schema_of_variant`` writes it, leaves only."""
    # a field's name, quoted if odd; the start of an object or list; an end
    marks = F.regexp_extract_all(shape, F.lit(r"(`(?:[^`]|``)*`: |[^\s<>,:`()]+: |OBJECT<|ARRAY<|>)"), F.lit(1))
    begin = F.struct(F.lit("").alias("at"), F.array().cast("array<string>").alias("open"),
                     F.array().cast("array<string>").alias("found"))

    def step(s: Column, mark: Column) -> Column:
        at, opened, found = s["at"], s["open"], s["found"]
        outer = F.element_at(opened, -1)
        name = F.regexp_replace(F.regexp_replace(F.regexp_replace(mark, ": $", ""), "^`|`$", ""), "``", "`")
        own = F.when(outer == "", name).otherwise(F.concat(outer, F.lit("."), name))
        element = F.concat(at, F.lit("[]"))
        inner = F.array_remove(found, at)   # what has parts is no leaf
        return (F.when(mark == "OBJECT<", F.struct(at.alias("at"), F.concat(opened, F.array(at)).alias("open"),
                                                   inner.alias("found")))
                .when(mark == "ARRAY<", F.struct(element.alias("at"), F.concat(opened, F.array(at)).alias("open"),
                                                 F.concat(inner, F.array(element)).alias("found")))
                .when(mark == ">", F.struct(outer.alias("at"), F.slice(opened, 1, F.size(opened) - 1).alias("open"),
                                            found.alias("found")))
                .otherwise(F.struct(own.alias("at"), opened.alias("open"),
                                    F.concat(found, F.array(own)).alias("found"))))

    return F.array_distinct(F.aggregate(marks, begin, step, lambda s: s["found"]))


def _text(v: Column, path: str) -> Column:
    """Text at a path: a string, or the parts' texts of a list; null if absent."""
    parts = F.transform(F.filter(F.try_variant_get(v, f"$.{path}", "array<variant>"), lambda p: p.isNotNull()),
                        lambda p: F.coalesce(F.try_variant_get(p, "$.text", "string"), F.lit("")))
    return F.coalesce(F.array_join(parts, ""), F.try_variant_get(v, f"$.{path}", "string"))


def _turns(v: Column, layout: Layout) -> Column:
    """The turns of a record by a layout's rules, as an array of ``TURN``."""
    def turn(role: Column, text: Column, place: Column | None = None) -> Column:
        return F.struct((F.lit(None).cast("bigint") if place is None else place).alias("place"),
                        F.lit(0).alias("pos"), F.coalesce(role, F.lit("")).alias("role"),
                        F.coalesce(text, F.lit("")).alias("text"))

    def listed(path: str) -> Column:
        return F.coalesce(F.try_variant_get(v, f"$.{path}", "array<variant>"), F.array().cast("array<variant>"))

    def elements(r: Each) -> Column:
        names = F.create_map(*[F.lit(x) for kv in SPEAKERS.items() for x in kv])

        def each(x: Column) -> Column:
            role = F.try_variant_get(x, f"$.{r.role}", "string")
            return turn(F.coalesce(F.try_element_at(names, F.lower(role)), role) if r.speakers else role,
                        _text(x, r.text))

        return F.transform(listed(r.path), each)

    some = []
    for r in layout.rules:
        if isinstance(r, Row):
            some.append(F.array(turn(F.try_variant_get(v, f"$.{r.role}", "string"), _text(v, r.text),
                                     F.try_variant_get(v, f"$.{r.place}", "bigint"))))
        elif isinstance(r, One):
            t = _text(v, r.path)
            one = F.array(turn(F.lit(r.role), t))
            some.append(one if r.always else F.when(t.isNotNull(), one).otherwise(F.slice(one, 1, 0)))
        elif isinstance(r, Joined):
            texts = F.filter(F.array(*[_text(v, p) for p in r.paths]), lambda t: F.coalesce(t, F.lit("")) != "")
            some.append(F.array(turn(F.lit(r.role), F.array_join(texts, "\n\n"))))
        elif isinstance(r, Each):
            some.append(elements(r))
        else:
            some.append(F.transform(listed(r.path), lambda x, i: turn(
                F.when(i % 2 == 0, "user").otherwise("assistant"), F.try_variant_get(x, "$", "string"))))
    return F.transform(F.concat(*some), lambda t, i: t.withField("pos", i.cast("int"))).cast(f"array<{TURN}>")


def _shape() -> Column:
    return F.coalesce(F.schema_of_variant("record"), F.lit("VOID"))


def layouts_of(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The layout of every shape that occurs: shape_key (its 128-bit hash),
    fingerprint, layout (null: none has that fingerprint) and n_records. A record
    that is null or no JSON has the fingerprint of no paths."""
    known = F.array(*[F.lit(p) for p in sorted({p for x in layouts for p in (*x.needs, *x.may)})])
    by_print = F.create_map(*[F.lit(x) for kv in fingerprints(layouts).items() for x in kv])
    shapes = (records.select(_shape().alias("shape")).groupBy(F.md5("shape").alias("shape_key"))
              .agg(F.first("shape").alias("shape"), F.count("*").alias("n_records")))
    mark = F.md5(F.array_join(F.array_sort(F.array_intersect(field_paths(F.col("shape")), known)), "\n"))
    return (shapes.select("shape_key", mark.alias("fingerprint"), "n_records")
            .withColumn("layout", F.try_element_at(by_print, F.col("fingerprint"))))


def conversations(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Canonical turns of ``records`` (conv_id of any type, record: VARIANT; more
    columns are dropped). One row per conv_id, null being one: conv_id, turns
    (array of ``TURN`` in order) and n_unmapped, its records of no known layout.

    Records with one conv_id are one conversation. Its turns are ordered by place
    (null first), position in the record, role and text, so ties and repeated
    rows have one order; repeated rows are turns of their own. Null texts and
    roles count as empty. An empty table gives no rows. A conversation is one
    row, however many turns it has, since its text and digests are one value.
    """
    of = small(stored(layouts_of(records, layouts), "layouts").select("shape_key", "layout"))
    mapped = records.withColumn("shape_key", F.md5(_shape())).join(of, "shape_key", "left")
    turns = F.array().cast(f"array<{TURN}>")
    for x in layouts:
        turns = F.when(F.col("layout") == x.name, _turns(F.col("record"), x)).otherwise(turns)
    return (mapped.select("conv_id", turns.alias("t"), F.col("layout").isNull().cast("long").alias("no"))
            .groupBy("conv_id").agg(F.collect_list("t").alias("t"), F.sum("no").alias("n_unmapped"))
            .select("conv_id", F.array_sort(F.flatten("t")).alias("turns"), "n_unmapped"))


def escaped(text: Column) -> Column:
    """``text`` with one more backslash in whatever could be read as a mark."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role_out(role: Column) -> Column:
    for a, b in (("%", "%25"), ("\n", "%0A"), ("|", "%7C")):
        role = F.replace(role, F.lit(a), F.lit(b))
    return role


def _role_in(role: Column) -> Column:
    for a, b in (("|", "%7C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(b), F.lit(a))
    return role


def formatted(convs: DataFrame, learn: str = "assistant") -> DataFrame:
    """Training text of ``convs`` (see :func:`conversations`): conv_id, text and
    ``mask``, one run (skip, take) per turn, which takes the texts of the role
    ``learn``. A conversation without turns has an empty text and no runs."""
    made = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), _role_out(t["role"]), F.lit("\n")).alias("head"), escaped(t["text"]).alias("body"),
        (t["role"] == learn).alias("learn")))
    c = convs.select("conv_id", made.alias("made"))
    run = F.transform("made", lambda m, i: F.struct(
        (F.when(i > 0, len(END)).otherwise(0) + F.length(m["head"])
         + F.when(m["learn"], 0).otherwise(F.length(m["body"]))).cast("long").alias("skip"),
        F.when(m["learn"], F.length(m["body"])).otherwise(0).cast("long").alias("take")))
    text = F.array_join(F.transform("made", lambda m: F.concat(m["head"], m["body"], F.lit(END))), "")
    return c.select("conv_id", text.alias("text"), run.alias("mask"))


def parsed(out: DataFrame) -> DataFrame:
    """What formatted text and mask say (conv_id, text, mask): conv_id, turns
    (role, text), loss_text, the unescaped text under the mask, and formatted_chars."""
    pieces = F.split("text", r"<\|im_end\|>\n", -1)
    c = out.select("conv_id", "text", F.arrays_zip(F.slice(pieces, 1, F.size(pieces) - 1).alias("piece"),
                                                   F.col("mask").alias("run")).alias("parts"))
    turns = F.transform("parts", lambda p: F.struct(
        _role_in(F.substr(F.substring_index(p["piece"], "\n", 1), F.lit(len(START) + 1))).alias("role"),
        unescaped(F.substr(p["piece"], F.length(F.substring_index(p["piece"], "\n", 1)) + 2)).alias("text")))
    taken = F.transform("parts", lambda p, i: unescaped(F.substr(
        p["piece"], p["run"]["skip"].cast("int") - F.when(i > 0, len(END)).otherwise(0) + 1,
        p["run"]["take"].cast("int"))))
    return c.select("conv_id", turns.alias("turns"), F.array_join(taken, "").alias("loss_text"),
                    F.length("text").cast("long").alias("formatted_chars"))


def digests(out: DataFrame) -> DataFrame:
    """Per conversation of formatted text: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, all from what :func:`parsed` reads."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parsed(out).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars")


def row_records(rows: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) as records: the ``rows`` layout.
    A null text or role is a field that holds null."""
    return rows.select("conv_id", F.to_variant_object(F.struct(
        F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"))).alias("record"))


def json_records(rows: DataFrame) -> DataFrame:
    """JSON records (conv_id, json) as records; what isn't JSON is a null record."""
    return rows.select("conv_id", F.try_parse_json("json").alias("record"))


def chat_digests(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Records formatted, written to the shared folder, read back and digested."""
    return digests(stored(formatted(conversations(records, layouts)), "chat"))
