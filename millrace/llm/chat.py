"""Chat formatting: fingerprints of nested field paths select the mapping that gives canonical turns.

1. A record of any layout is a variant. The field paths that it has, of those that any layout names, are
   listed in a fixed order and hashed; the hash selects a layout. A table with one row per turn is selected
   by the paths of its schema in the same way.
2. A layout is data: where the turns are, where each has its role and its text, and what its roles mean.
   It is applied as column expressions and gives turns of a role and a text.
3. A template puts marks around every turn. Control strings inside texts are broken by an escape sign, so a
   mark is never part of a text, and the formatted text gives back the turns. Texts of the assistant are
   under the loss mask.

Escaping and marking are column expressions on single turns. Rows of a conversation are only brought
together in order, never as a group: a task reads them one after another and writes formatted rows of
bounded length, so a conversation with a third of all rows needs no more memory than another.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"
#: Characters after which a conversation goes on in a further row.
CHUNK = 4_000_000
#: Other names of roles in published layouts.
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


# Layouts ---------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Listed:
    """A record with a list of turns; ``role`` and ``text`` are paths inside an element."""

    name: str
    items: str
    role: str
    text: str
    roles: dict[str, str] = field(default_factory=dict)

    def required(self) -> tuple[str, ...]:
        return (self.items,)

    def optional(self) -> tuple[str, ...]:
        return (f"{self.items}[].{self.role}", f"{self.items}[].{self.text}")

    def turns(self, record: Column) -> Column:
        names = F.create_map(*[F.lit(x) for pair in self.roles.items() for x in pair]) if self.roles else None

        def turn(item: Column) -> Column:
            role = F.coalesce(_text(item, self.role), F.lit(""))
            return F.struct((F.coalesce(F.element_at(names, role), role) if self.roles else role).alias("role"),
                            F.coalesce(_text(item, self.text), F.lit("")).alias("text"))

        return F.transform(_items(record, self.items), turn)


@dataclass(frozen=True)
class Fixed:
    """A record with fields of its own per turn: ``(role, paths)``; texts of several paths are joined by an empty line.

    A turn whose paths are all absent is left out; paths that end in ``?`` may be absent.
    """

    name: str
    says: tuple[tuple[str, tuple[str, ...]], ...]

    def required(self) -> tuple[str, ...]:
        return tuple(p for _, paths in self.says for p in paths if not p.endswith("?"))

    def optional(self) -> tuple[str, ...]:
        return tuple(p[:-1] for _, paths in self.says for p in paths if p.endswith("?"))

    def turns(self, record: Column) -> Column:
        def turn(role: str, paths: tuple[str, ...]) -> Column:
            texts = F.array_compact(F.array(*[_text(record, p.rstrip("?")) for p in paths]))
            return F.when(F.size(texts) > 0, F.struct(
                F.lit(role).alias("role"),
                F.array_join(F.when(F.size(texts) > 1, F.filter(texts, lambda t: t != "")).otherwise(texts), "\n\n").alias("text")))

        return F.array_compact(F.array(*[turn(*s) for s in self.says]))


@dataclass(frozen=True)
class Rows:
    """A table with one row per turn: columns of the conversation, the order, the role and the text."""

    name: str
    conv: str
    order: str
    role: str
    text: str

    def required(self) -> tuple[str, ...]:
        return self.conv, self.order, self.role, self.text

    def optional(self) -> tuple[str, ...]:
        return ()


#: Layouts of records, and of tables of turns. The first of several that fit as well is taken.
RECORDS = (
    Listed("messages", "messages", "role", "content"),
    Listed("authored messages", "messages", "author.role", "content.text"),
    Listed("conversations", "conversations", "from", "value", ROLE_NAMES),
    Fixed("instruction", (("system", ("system?",)), ("user", ("instruction", "input?")), ("assistant", ("output",)))),
    Fixed("prompt and completion", (("system", ("system?",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Fixed("prompt and response", (("system", ("system?",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Fixed("question and answer", (("user", ("context?", "question")), ("assistant", ("answer",)))),
)
TABLES = (Rows("turns", "conv_id", "turn", "role", "text"), Rows("message rows", "conversation_id", "position", "author", "content"))


def vocabulary(layouts: Iterable) -> list[str]:
    """All paths that layouts name, sorted."""
    return sorted({p for one in layouts for p in (*one.required(), *one.optional())})


def fingerprint(paths: Iterable[str]) -> str:
    """SHA-256 of the sorted paths, one a line."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def registry(layouts: Iterable) -> dict[str, str]:
    """Layout name by fingerprint: its required paths with any of its optional ones. Earlier layouts win."""
    found: dict[str, str] = {}
    for one in layouts:
        extra = one.optional()
        for n in range(len(extra) + 1):
            for some in combinations(extra, n):
                found.setdefault(fingerprint((*one.required(), *some)), one.name)
    return found


def best_fit(paths: Iterable[str], layouts: Iterable) -> str | None:
    """The layout with the most of its paths among ``paths``, if all that it requires are there."""
    have = set(paths)
    fits = [one for one in layouts if have.issuperset(one.required())]
    best = max(fits, key=lambda one: len(have.intersection((*one.required(), *one.optional()))), default=None)
    return best and best.name


def _items(record: Column, path: str) -> Column:
    return F.try_variant_get(record, f"$.{path}", "array<variant>")


def _text(record: Column, path: str) -> Column:
    return F.try_variant_get(record, f"$.{path}", "string")


def _present(record: Column, path: str) -> Column:
    """Whether the record has the path with a value other than null; inside a list, whether any element has it."""
    if "[]." in path:
        items, inner = path.split("[].", 1)
        return F.coalesce(F.exists(_items(record, items), lambda x: _text(x, inner).isNotNull()), F.lit(False))
    value = F.try_variant_get(record, f"$.{path}", "variant")
    return value.isNotNull() & ~F.is_variant_null(value)


def record_of(df: DataFrame, col: str) -> Column:
    """A column as a variant: JSON text is parsed (null if it is none), nested columns are taken as they are."""
    kind = dict(df.dtypes)[col]
    value = F.col(f"`{col}`")
    if kind == "variant":
        return value
    return F.try_parse_json(value) if kind == "string" else F.to_variant_object(value)


def canonical(df: DataFrame, record_col: str = "record", layouts: tuple = RECORDS) -> DataFrame:
    """``df`` with ``fingerprint``, ``layout`` and ``turns`` (an array of role and text) of its records.

    A fingerprint that the registry knows selects its layout; one with further known paths gets the layout that
    covers most of them. Where none fits, also for a null record or text that is not JSON, layout and turns are null
    and the row stays, so that nothing is lost unseen. A list without elements gives no turns. Nulls count as absent
    fields; a turn of a list without role or text has an empty one. Other columns stay; columns of these three names
    are replaced. Repeated rows are formatted each.
    """
    words = vocabulary(layouts)
    known = registry(layouts)
    names = {one.name: i for i, one in enumerate(layouts)}
    kept = [c for c in df.columns if c not in ("fingerprint", "layout", "turns")]
    step = df.select(*[F.col(f"`{c}`") for c in kept if c != record_col], F.struct(
        F.col(f"`{record_col}`").alias("raw"), record_of(df, record_col).alias("record")).alias("__r"))
    record = F.col("__r.record")
    step = step.withColumn("__p", F.array_compact(F.array(*[F.when(_present(record, p), F.lit(p)) for p in words])))
    step = step.withColumn("__f", F.sha2(F.array_join("__p", "\n"), 256))
    exact = F.coalesce(*[F.when(F.col("__f").isin([f for f, n in known.items() if n == name]), F.lit(i))
                         for name, i in names.items()])
    # Fit of every layout: paths covered, earlier layouts first; -1 where a required path is missing.
    fits = F.array(*[F.struct(
        F.when(F.size(F.array_except(F.array(*map(F.lit, one.required())), F.col("__p"))) > 0, F.lit(-1)).otherwise(
            F.size(F.array_intersect(F.array(*map(F.lit, (*one.required(), *one.optional()))), F.col("__p")))).alias("covered"),
        F.lit(-i).alias("place")) for i, one in enumerate(layouts)])
    close = F.array_max(fits)
    step = step.withColumn("__l", F.coalesce(exact, F.when(close["covered"] >= 0, -close["place"])))
    turns = F.coalesce(*[F.when(F.col("__l") == i, one.turns(record)) for i, one in enumerate(layouts)])
    return step.select(
        *[F.col("__r.raw").alias(c) if c == record_col else F.col(f"`{c}`") for c in kept], F.col("__f").alias("fingerprint"),
        F.get(F.array(*[F.lit(one.name) for one in layouts]), F.col("__l")).alias("layout"), turns.alias("turns"))


def turn_rows(df: DataFrame, layouts: tuple = TABLES) -> DataFrame:
    """A table of turns, whose schema's fingerprint selects the layout, as ``(conv_id, turn, role, text)`` rows.

    Null roles and texts are empty. Columns that no layout names are ignored.
    """
    have = [c for c in df.columns if c in vocabulary(layouts)]
    name = registry(layouts).get(fingerprint(have)) or best_fit(have, layouts)
    if not name:
        raise ValueError(f"no layout fits the columns {df.columns}")
    one = next(x for x in layouts if x.name == name)
    return df.select(F.col(one.conv).alias("conv_id"), F.col(one.order).alias("turn"),
                     *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((one.role, "role"), (one.text, "text"))])


# Template --------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Template:
    """Marks before and after the text of a role; turns of other roles carry their role between marks."""

    marks: dict[str, tuple[str, str]]
    role_marks: tuple[str, str]
    end: str
    loss: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        if any(not re.fullmatch(r"[<\[][^<\[\\\s]+", c) for c in self.controls()):
            raise ValueError("a control string is one of < and [, and then none of < [ \\ and white space")
        opens = [m[0] for m in self.marks.values()] + [self.role_marks[0]]
        if any(a != b and a.startswith(b) for a in opens for b in opens) or len(set(opens)) < len(opens):
            raise ValueError("no opening mark may begin with another")

    def controls(self) -> list[str]:
        return sorted({m.strip() for m in [x for pair in self.marks.values() for x in pair] + [*self.role_marks, self.end]})

    def escape_pattern(self) -> str:
        """The first character of a control string."""
        return r"([<\[])(?=" + "|".join(re.sub(r"([^\w/])", r"\\\1", c[1:]) for c in self.controls()) + ")"


TEMPLATE = Template({"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[OUT] ", " </s>")},
                    ("[ROLE] ", " [/ROLE] "), " [/TURN]")


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    """Doubles every escape sign and puts one after the first character of every control string."""
    return F.regexp_replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2)), template.escape_pattern(), r"$1\\")


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def segment(role: Column, text: Column, template: Template = TEMPLATE) -> Column:
    """A turn as ``(segment, loss_start, loss_end)``: its formatted text and the code points under the loss mask in it.

    Turns without loss have an empty mask at 0.
    """
    first, last = template.role_marks
    head = F.concat(F.lit(first), escape(role, template), F.lit(last))
    tail = F.lit(template.end)
    for name, (before, after) in template.marks.items():
        head = F.when(role == name, F.lit(before)).otherwise(head)
        tail = F.when(role == name, F.lit(after)).otherwise(tail)
    body, masked = escape(text, template), role.isin(*template.loss)
    return F.struct(F.concat(head, body, tail).alias("segment"),
                    F.when(masked, F.length(head)).otherwise(0).alias("loss_start"),
                    F.when(masked, F.length(head) + F.length(body)).otherwise(0).alias("loss_end"))


def format_records(df: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Rows of :func:`canonical` with ``formatted`` and ``loss``, the spans of code points under the loss mask.

    Both are null where no layout fits. A record is one row already, so nothing is shuffled.
    """
    parts = F.transform("turns", lambda t: segment(t["role"], t["text"], template))
    ends = F.aggregate("__s", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
                       lambda acc, s: F.struct(
                           (acc["at"] + F.length(s["segment"])).alias("at"),
                           F.when(s["loss_end"] > 0, F.concat(acc["spans"], F.array(F.struct(
                               (acc["at"] + s["loss_start"]).alias("start"), (acc["at"] + s["loss_end"]).alias("end"))))).otherwise(
                                   acc["spans"]).alias("spans")))
    kept = [c for c in df.columns if c not in ("formatted", "loss")]
    return df.select(*[F.col(f"`{c}`") for c in kept], parts.alias("__s")).select(
        *[F.col(f"`{c}`") for c in kept], F.array_join(F.transform("__s", lambda s: s["segment"]), "").alias("formatted"),
        ends["spans"].alias("loss"))


def read_turns(formatted: str, template: Template = TEMPLATE) -> Iterator[tuple[str, str]]:
    """The ``(role, text)`` turns of a formatted text."""
    at, (first, last) = 0, template.role_marks
    while at < len(formatted):
        for role, (before, after) in template.marks.items():
            if formatted.startswith(before, at):
                start = at + len(before)
                break
        else:
            if not formatted.startswith(first, at):
                raise ValueError(f"no mark of a turn at {at}")
            stop = formatted.index(last, at + len(first))
            role, start, after = unescape(formatted[at + len(first):stop]), stop + len(last), template.end
        end = formatted.index(after, start)
        yield role, unescape(formatted[start:end])
        at = end + len(after)


def read_loss(formatted: str, spans: Iterable[dict]) -> Iterator[str]:
    """The texts under the loss mask."""
    for s in spans:
        yield unescape(formatted[s["start"]:s["end"]])


def format_rows(df: DataFrame, template: Template = TEMPLATE, layouts: tuple = TABLES, chunk: int = CHUNK) -> DataFrame:
    """Conversations of a table of turns as ``(conv_id, chunk, n_turns, formatted, loss)`` rows.

    A conversation is one row, or several, numbered from 0, if its text passes ``chunk`` characters; they are cut
    between turns and follow each other in the same partition. Turns are in the order of ``turn``, null first, and
    by their formatted text where it is equal. Repeated rows are turns of their own. Rows without a conversation
    make one with a null id. An empty table gives an empty result.
    """
    turns = turn_rows(df, layouts)
    parts = turns.select("conv_id", "turn", segment(F.col("role"), F.col("text"), template).alias("s")).select("conv_id", "turn", "s.*")
    dealt = parts.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, number, texts, spans, size, done = object(), 0, [], [], 0, []
        span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

        def flush() -> pa.RecordBatch:
            types = [id_type, pa.int32(), pa.int32(), pa.string(), span_type]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)],
                                             names=["conv_id", "chunk", "n_turns", "formatted", "loss"])
            done.clear()
            return out

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for conv, text, start, end in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end")]):
                fresh = conv != here
                if texts and (fresh or size + len(text) > chunk):
                    done.append((here, number, len(texts), "".join(texts), spans))
                    if size > chunk // 8:
                        yield flush()
                    number, texts, spans, size = number + 1, [], [], 0
                if fresh:
                    here, number = conv, 0
                if end:
                    spans.append({"start": size + start, "end": size + end})
                texts.append(text)
                size += len(text)
            if done:
                yield flush()
        if texts:
            done.append((here, number, len(texts), "".join(texts), spans))
            yield flush()

    return dealt.mapInArrow(run, f"conv_id {dict(parts.dtypes)['conv_id']}, chunk int, n_turns int, formatted string, "
                                 "loss array<struct<start:int,end:int>>")


def digests(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """What :func:`format_rows` wrote, read back: one row per conversation.

    Columns are ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``. Rows of a conversation are
    read one after another where they were written, and the digests take them in turn by turn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, id_type, done = None, None, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done))
            types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        def close() -> None:
            conv, n, turns, chars, loss, total = state
            done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total))

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for conv, number, text, spans in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "chunk", "formatted", "loss")]):
                if number == 0:
                    if state:
                        close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_turns(text, template):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for said in read_loss(text, spans):
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(text)
            if len(done) >= 1000:
                yield flush()
                done.clear()
        if state:
            close()
            yield flush()

    return formatted.mapInArrow(run, f"conv_id {dict(formatted.dtypes)['conv_id']}, n_turns long, turns_sha256 string, "
                                     "loss_chars long, loss_sha256 string, formatted_chars long")
