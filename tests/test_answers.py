"""Prompt rendering and tolerant answer parsing."""

import json

from pyspark.sql import functions as F

from needlens.functions.respond import need_records, parse_answers, render

BASE = {"is_financial": True, "entity": "mortgage", "feature": "renewal letter", "opinion": "arrives late",
        "need_type": "implicit", "pain_point": "deadline missed", "root_cause": "poor_notice", "sentiment": "negative",
        "emotion": "annoyance", "intensity": 0.6, "evidence": "the letter came after the date", "user_type": "casual",
        "experience_level": "beginner"}


def parse(spark, answers, text="post text " * 10):
    df = spark.createDataFrame([(i, a, text) for i, a in enumerate(answers)], "i int, answer string, text string")
    out = need_records(parse_answers(df, "answer", "v"), "v", "text", "r")
    return {r["i"]: r["r"] for r in out.select("i", "r").collect()}


def variant(**kw):
    d = dict(BASE)
    for k, v in kw.items():
        if v is ...:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


def test_enum_fallbacks(spark):
    r = parse(spark, [variant(user_type="alien"), variant(sentiment="mixed")])
    assert r[0]["user_type"] == "casual" and r[0]["keep"]
    assert r[1]["sentiment"] == "neutral" and r[1]["keep"]


def test_intensity_clamp_missing_null_text(spark):
    r = parse(spark, [variant(intensity=1.5), variant(intensity=...), variant(intensity=None),
                      variant(intensity="0.6"), variant(intensity="abc"), variant(intensity=True)])
    assert r[0]["intensity"] == 1.0 and r[0]["keep"]
    assert r[1]["intensity"] == 0.5 and r[1]["keep"]
    assert not r[2]["keep"]
    assert r[3]["intensity"] == 0.6 and r[3]["keep"]
    assert not r[4]["keep"]
    assert r[5]["intensity"] == 1.0 and r[5]["keep"]


def test_domain_gate(spark):
    r = parse(spark, [variant(is_financial=True), variant(is_financial=False), variant(is_financial=...),
                      variant(is_financial="false")])
    assert r[0]["keep"] and not r[1]["keep"] and r[1]["skipped"]
    assert r[2]["keep"] and r[3]["keep"]


def test_truthy_defaults_and_type_errors(spark):
    r = parse(spark, [variant(entity="", evidence=..., emotion=0), variant(entity=5),
                      variant(need_type=["explicit"]), variant(pain_point=3), variant(root_cause=None)],
              text="x" * 100)
    assert r[0]["entity"] == "unknown" and r[0]["evidence"] == "x" * 60 and r[0]["emotion"] == "neutral"
    assert not r[1]["keep"] and not r[2]["keep"] and not r[3]["keep"]
    assert r[4]["keep"] and r[4]["root_cause"] is None


def test_tolerant_parse_shapes(spark):
    body = variant()
    answers = ["```json\n" + body + "\n```", body.replace("arrives late", "it\\'s high"),
               body.replace("arrives late", "line1\nline2"), "Sure! " + body + " Bye.", "no json here",
               "[" + body + "]"]
    r = parse(spark, answers)
    assert r[0]["keep"] and r[1]["opinion"] == "it's high" and r[2]["opinion"] == "line1\nline2"
    assert r[3]["keep"] and not r[4]["keep"] and not r[5]["keep"]


def test_failed_middle_row(spark):
    r = parse(spark, [variant(), "garbage", variant()])
    assert [r[i]["keep"] for i in range(3)] == [True, False, True]


def test_render_is_sequential_literal_replace(spark):
    df = spark.createDataFrame([("A", "{b}")], "a string, b string")
    out = df.select(render('{"x": {a}} {b} {c}', [("a", F.col("a")), ("b", F.col("b"))])).first()[0]
    # {a} -> A; {b} -> "{b}" (the value itself), other braces untouched
    assert out == '{"x": A} {b} {c}'


def test_solutions_with_an_entry_that_is_no_object(spark):
    from needlens.functions.respond import solutions_readable
    rows = [("objects", '{"solutions": [{"name": "A"}, {}]}'), ("none", '{"other": 1}'), ("failed", None),
            ("text", '{"solutions": [{"name": "A"}, "B"]}'), ("null", '{"solutions": [null]}')]
    df = parse_answers(spark.createDataFrame(rows, "id string, answer string"), "answer", "v")
    got = {r["id"]: r["ok"] for r in df.select("id", solutions_readable(F.col("v")).alias("ok")).collect()}
    assert got == {"objects": True, "none": True, "failed": True, "text": False, "null": False}
