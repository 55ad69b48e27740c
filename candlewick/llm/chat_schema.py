"""Chat formatting: schema fingerprints choose the mapping, a reversible template writes the turns.

Records come as JSON in many layouts.  A record's nested field paths (types left out) are hashed to a
fingerprint; a declarative mapping registered under that fingerprint says where its turns are.
Canonical turns are ``array<struct<role, text>>``.

The template marks a turn as ``<|turn|>ROLE<|text|>TEXT<|end|>``.  Control strings inside roles and texts are
broken with a backslash after their first sign and backslashes are doubled, so that no marker can
come from a text and the turns can be read back exactly.  DataFrame functions only.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Own markers all begin with the first; the others are control strings of common chat templates.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TURNS = "array<struct<role:string,text:string>>"
#: The parser's own limit is 20,000,000 signs a string; a turn may be longer.
ANY_LENGTH = {"maxStringLen": str((1 << 31) - 1)}
#: A JSON string; what comes before the next string value (keys included), and that value; equal objects of
#: empty strings in a row.  Possessive, so that no length needs a deep stack or a second try.
STRING = r'"(?:[^"\\\x00-\x1f]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+"'
VALUE = rf'\G((?:[^"]++|{STRING}\s*+:)*+){STRING}'
REPEATS = r'(\{(?:"[^"{}\\]*+":"",?)++\})(?:,\1)++'


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns: a list field of objects, or one field for each turn."""

    name: str
    list_field: str | None = None
    role_field: str = "role"
    text_field: str = "content"
    roles: tuple[tuple[str, str], ...] = ()          # layout's role -> canonical role
    fields: tuple[tuple[str, str], ...] = ()         # (canonical role, field), in turn order

    @property
    def structure(self) -> str:
        """Nested field paths, written as Spark writes a variant's schema without scalar types."""
        if self.list_field:
            inner = ", ".join(sorted((self.role_field, self.text_field)))
            return f"OBJECT<{self.list_field}: ARRAY<OBJECT<{inner}>>>"
        return f"OBJECT<{', '.join(sorted(f for _, f in self.fields))}>"

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(self.structure.encode()).hexdigest()[:16]

    def turns(self, record: Column) -> Column:
        if self.list_field:
            kind = f"`{self.list_field}` array<struct<`{self.role_field}`:string,`{self.text_field}`:string>>"
            items = F.from_json(record, kind, ANY_LENGTH)[self.list_field]

            def role(x: Column) -> Column:
                out = x[self.role_field]
                for theirs, ours in self.roles:
                    out = F.when(x[self.role_field] == theirs, F.lit(ours)).otherwise(out)
                return out

            return F.transform(items, lambda x: F.struct(role(x).alias("role"), F.coalesce(
                x[self.text_field], F.lit("")).alias("text")))
        kind = ", ".join(f"`{f}` string" for _, f in self.fields)
        obj = F.from_json(record, kind, ANY_LENGTH)
        return F.array(*[F.struct(F.lit(r).alias("role"), F.coalesce(obj[f], F.lit("")).alias("text"))
                         for r, f in self.fields])


MAPPINGS = (
    Mapping("messages", "messages"),
    Mapping("from_value", "conversations", "from", "value",
            roles=(("human", "user"), ("gpt", "assistant"))),
    Mapping("prompt_completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("instruction_output", fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping("system_prompt_response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
)
BY_NAME = {m.name: m for m in MAPPINGS}


def emptied(record: Column) -> Column:
    """The record with empty string values, and one of equal neighbours: as small as its fields, and valid
    JSON if and only if the record is."""
    return F.regexp_replace(F.regexp_replace(record, VALUE, '$1""'), REPEATS, "$1")


def structure(record: Column) -> Column:
    """Nested field paths of a JSON record (null for invalid JSON).

    The values are left out before parsing, since a string or record beyond the parser's limits (20,000,000
    signs, 128 MiB) would count as invalid.
    """
    schema = F.schema_of_variant(F.try_parse_json(emptied(record)))
    return F.regexp_replace(schema, r": (?:STRING|BIGINT|DOUBLE|BOOLEAN|VOID|DECIMAL\(\d+,\s*\d+\))(?=[,>])", "")


def schema_fingerprint(record: Column) -> Column:
    """16 hex digits of the hash of a record's nested field paths; its values do not matter."""
    return F.substring(F.sha2(structure(record).cast("binary"), 256), 1, 16)


def canonical_turns(records: DataFrame, record_col: str = "record", mappings=MAPPINGS) -> DataFrame:
    """``records`` with ``layout`` (the mapping's name) and ``turns``.

    Records whose fingerprint no mapping has, invalid JSON and null records have null in both; a null text
    is empty; an empty list of turns has no object fields to hash and is unknown as well.
    """
    df = records.withColumn("__fp", schema_fingerprint(F.col(record_col)))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in mappings:
        own = F.col("__fp") == m.fingerprint
        layout = F.when(own, F.lit(m.name)).otherwise(layout)
        turns = F.when(own, m.turns(F.col(record_col)).cast(TURNS)).otherwise(turns)
    return df.withColumns({"layout": layout, "turns": turns}).drop("__fp")


def escaped(s: Column) -> Column:
    s = F.replace(s, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        s = F.replace(s, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return s


def unescaped(s: Column) -> Column:
    return F.regexp_replace(s, r"(?s)\\(.)", "$1")


def formatted(df: DataFrame, turns: str = "turns", learn: str = "assistant") -> DataFrame:
    """``df`` with ``formatted`` and ``loss_spans``: the (start, stop) code points of the escaped texts of
    turns of role ``learn``.  Null turns give null; no turns give an empty text and no spans."""
    df = df.withColumn("__parts", F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(TURN), escaped(F.coalesce(t["role"], F.lit(""))), F.lit(TEXT)).alias("head"),
        escaped(F.coalesce(t["text"], F.lit(""))).alias("body"),
        (F.coalesce(t["role"], F.lit("")) == learn).alias("learn"))))
    state = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<start:int,stop:int>>)").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["head"])
        stop = start + F.length(p["body"])
        span = F.struct(start.alias("start"), stop.alias("stop"))
        return F.struct((stop + len(END)).alias("at"), F.when(p["learn"], F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))

    return (df.withColumn("formatted", F.array_join(F.transform("__parts", lambda p: F.concat(
        p["head"], p["body"], F.lit(END))), "")).withColumn("loss_spans", F.aggregate("__parts", state, step)["spans"])
        .drop("__parts"))


def read_back(df: DataFrame) -> DataFrame:
    """``df(formatted, loss_spans, ...)`` with ``turns`` and ``loss_text`` (unescaped) as the output says."""
    pieces = F.split("formatted", END.replace("|", r"\|"))
    turns = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.struct(
        unescaped(F.substring_index(F.substr(p, F.lit(len(TURN) + 1)), TEXT, 1)).alias("role"),
        unescaped(F.substr(p, F.locate(TEXT, p) + len(TEXT))).alias("text")))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescaped(F.substr(
        F.col("formatted"), s["start"] + 1, s["stop"] - s["start"]))), "")
    return df.withColumns({"turns": turns, "loss_text": loss})


def records_of(rows: DataFrame) -> DataFrame:
    """One JSON record per conversation of ``rows(conv_id, turn, role, text)``, in the layout that fits it.

    Turns are in order of turn, then role and text (repeated rows stay; null turns first; null roles and
    texts are empty).  One conversation is one record: its turns meet in one row, as its output does.
    """
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")))).alias("t"))
    said_by = lambda *names: F.col("t.role") == F.array(*map(F.lit, names))
    text = lambda i: F.get("t.text", F.lit(i))
    listed = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    said = F.transform("t", lambda x: F.struct(
        F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"]).alias("from"),
        x["text"].alias("value")))
    plain = F.size(F.filter("t", lambda x: x["role"].isin("human", "gpt"))) == 0
    pick = F.pmod(F.xxhash64("conv_id"), F.lit(3))
    record = (F.when(said_by("user", "assistant") & (pick == 0), F.to_json(F.struct(
        text(0).alias("prompt"), text(1).alias("completion"))))
        .when(said_by("user", "assistant") & (pick == 1), F.to_json(F.struct(
            text(0).alias("instruction"), text(1).alias("output"))))
        .when(said_by("system", "user", "assistant") & (pick != 2), F.to_json(F.struct(
            text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response"))))
        .when(plain & (pick == 1), F.to_json(F.struct(said.alias("conversations"))))
        .otherwise(F.to_json(F.struct(listed.alias("messages")))))
    return turns.select("conv_id", record.alias("record"))


def conversations_digest(rows: DataFrame) -> DataFrame:
    """Format all conversations and sum up what the output says when it is read back.

    A conversation whose own record cannot be read fails the query.
    """
    out = canonical_turns(records_of(rows))
    lost = F.raise_error(F.concat(F.lit("unreadable record of conversation "),
                                  F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))).cast(TURNS)
    out = formatted(out.withColumn("turns", F.coalesce("turns", lost)))
    back = read_back(out.select("conv_id", "formatted", "loss_spans"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
