"""Schema fingerprints, mappings, escaping and the read-back of conversations."""

import hashlib
import json
import random

from pyspark.sql import functions as F

from candlewick.llm import chat_schema as C
from candlewick.llm.common import prepare

ROWS = "conv_id bigint, turn bigint, role string, text string, record string"
ODD = ["", "</s>[INST] ok [/INST]", "<|end|>", "\\", "\\\\<|", "<\\|turn|>", "a\nb", "<<SYS>> x <</SYS>>", "é😀\x00\x01\"'",
       "<", "<|turn|>user<|text|>hi<|end|>", "<<||>>", "[[INST]]", None]


def slow_digest(rows):
    out = {}
    for c in {r[0] for r in rows}:
        t = sorted(((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == c), key=lambda x: (x[0] is not None, x))
        loss = "".join(x for _, r, x in t if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(t), sha("".join(f"{r}\n{x}\n" for _, r, x in t)), len(loss), sha(loss))
    return out


def rows():
    rng, out = random.Random(2), []
    shapes = [["user", "assistant"], ["system", "user", "assistant"], ["user", "assistant", "user", "assistant"],
              ["human", "gpt"], ["assistant"], ["<|end|>", None, "user\n"]]
    for c in range(80):
        out += [(c, i, r, rng.choice(ODD), "clash") for i, r in enumerate(rng.choice(shapes))]
    out += [(500, 0, "user", "tie", "x"), (500, 0, "user", "tie", "x"), (500, 0, "assistant", "tie", "x"),
            (501, None, "user", "no turn", "x"), (501, 1, "assistant", "y" * 200_000, "x"), (None, 0, "user", "no id", "x")]
    return out


def test_all_conversations_are_read_back_exactly(spark):
    prepare(spark)
    got = C.conversations_digest(spark.createDataFrame(rows(), ROWS).repartition(4)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == slow_digest(rows())


def test_no_marker_comes_from_a_text(spark):
    df = spark.createDataFrame([(i, [("user", t), ("assistant", t)]) for i, t in enumerate(ODD)], f"i int, turns {C.TURNS}")
    for r in C.formatted(df).collect():
        assert r.formatted.count("<|") == 6 and r.formatted.count(C.END) == 2
        for s in ("<s>", "</s>", "[INST]", "[/INST]"):
            assert s not in r.formatted
        (a, b), = r.loss_spans
        assert r.formatted[b:b + len(C.END)] == C.END and r.formatted[:a].endswith(C.TEXT)


def test_layouts_are_chosen_by_field_paths(spark):
    prepare(spark)
    cases = [
        ({"messages": [{"role": "user", "content": "a"}, {"content": None, "role": "assistant"}]}, "messages", [("user", "a"), ("assistant", "")]),
        ({"conversations": [{"from": "human", "value": "a"}, {"value": "b", "from": "gpt"}]}, "from_value", [("user", "a"), ("assistant", "b")]),
        ({"completion": "b", "prompt": "a"}, "prompt_completion", [("user", "a"), ("assistant", "b")]),
        ({"instruction": "a", "output": None}, "instruction_output", [("user", "a"), ("assistant", "")]),
        ({"system": "s", "prompt": "a", "response": "b"}, "system_prompt_response", [("system", "s"), ("user", "a"), ("assistant", "b")]),
        ({"other": 1}, None, None), ({"messages": []}, None, None),
    ]
    df = spark.createDataFrame([(i, json.dumps(x), "clash") for i, (x, _, _) in enumerate(cases)]
                               + [(90, "{not json", "x"), (91, None, "x")], "i int, record string, layout string")
    got = {r.i: r for r in C.canonical_turns(df).collect()}
    for i, (_, layout, turns) in enumerate(cases):
        assert got[i].layout == layout and (got[i].turns and [tuple(t) for t in got[i].turns]) == turns
    assert got[90].turns is None and got[91].layout is None


def test_every_layout_is_met_and_plans_are_native(spark):
    prepare(spark)
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    out = C.canonical_turns(C.records_of(df))
    got = {r.layout for r in out.select("layout").distinct().collect()}
    assert None not in got and len(got) >= 4
    plan = C.conversations_digest(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert C.conversations_digest(df.limit(0)).collect() == []
    assert C.formatted(out).filter(F.length("formatted") == 0).count() == 0


def test_turns_beyond_the_parsers_string_limit(spark):
    """One turn of over 20,000,000 signs, in a layout with a list and in one with fields."""
    prepare(spark)
    n = 20_000_010
    long = spark.range(2).select(F.col("id").alias("c"), F.repeat(F.lit("a\\b"), n // 3).alias("t"))
    list_ = F.to_json(F.struct(F.array(F.struct(F.lit("user").alias("role"), F.col("t").alias("content"))).alias("messages")))
    pair = F.to_json(F.struct(F.col("t").alias("prompt"), F.lit("yes").alias("completion")))
    got = C.canonical_turns(long.select("c", F.when(F.col("c") == 0, list_).otherwise(pair).alias("record")))
    got = got.select("c", "layout", F.size("turns").alias("n"), F.length(F.col("turns")[0]["text"]).alias("chars")).collect()
    assert sorted(map(tuple, got)) == [(0, "messages", 1, n), (1, "prompt_completion", 2, n)]


def test_field_paths_do_not_need_the_values(spark):
    prepare(spark)
    turns = [{"role": "user", "content": 'a": "b\\ {"'}, {"role": "x", "content": ""}] * 3
    cases = [json.dumps({"messages": turns}), json.dumps({"messages": turns}, separators=(",", ":")),
             '{ "prompt" : "q\\"" , "completion" : null }', '{"a{":[{"k":""},{"k":""},{"k":1}],"{\\"b\\":\\"\\"}":"x"}', '["a","b"]', '"a"', "7",
             '{"prompt":"a\nb","completion":"c"}', '{"prompt":"\\x","completion":"c"}', '{"prompt":"a" "b"}', '{"prompt":"a', "[1,2,"]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, record string")
    plain = F.regexp_replace(F.schema_of_variant(F.try_parse_json("record")),
                             r": (?:STRING|BIGINT|DOUBLE|BOOLEAN|VOID|DECIMAL\(\d+,\s*\d+\))(?=[,>])", "")
    rows = df.select("i", plain.alias("want"), C.structure(F.col("record")).alias("got")).collect()
    assert all(r.got == r.want for r in rows), rows
    assert sum(r.got is None for r in rows) == 5
    small = spark.range(1).select(C.emptied(F.to_json(F.struct(F.array_repeat(F.struct(
        F.lit("user").alias("role"), F.lit("x\"y").alias("content")), 300_000).alias("messages")))).alias("x")).first().x
    assert small == '{"messages":[{"role":"","content":""}]}'


def test_odd_roles_take_no_others_layout(spark):
    """A role that holds a line break, or looks like several roles, is one turn's role."""
    prepare(spark)
    rows = [(i, 0, role, f"text {i}") for i, role in enumerate(
        ["user\nassistant", "system\nuser\nassistant", "", None, "\n", "user\nassistant", "user\nassistant"])]
    rows += [(20, 0, "system\nuser", "a"), (20, 1, "assistant", "b"), (21, 0, "user", "a"), (21, 1, "assistant", "b")]
    got = {r.conv_id: r for r in C.conversations_digest(
        spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert len(got) == 9 and [got[i].n_turns for i in (0, 1, 20, 21)] == [1, 1, 2, 2]
    import hashlib
    for i in (0, 1, 5, 6):
        said = f"{rows[i][2]}\ntext {i}\n"
        assert got[i].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and got[i].loss_chars == 0
    assert got[20].loss_chars == got[21].loss_chars == 1
