import re

from needlens.llm import licenses as L


def _want(rows, t=0.8):
    out = []
    sets = {n: set(L.template_bigrams(x)) for n, x in L.TEMPLATES.items()}
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        units = list(enumerate(lines)) + ([(-1, text.replace("\n", " "))] if len(lines) > 1 else [])
        for k, u in units:
            w = re.sub(r"[\W_]+", " ", u.lower()).split()
            a = set(zip(w, w[1:]))
            a = {f"{x} {y}" for x, y in a}
            for n, b in sets.items():
                d = 2 * len(a & b) / (len(a) + len(b))
                if a and d >= t:
                    out.append((i, k, None, n, len(a & b), len(a), round(d, 9)))
        w = re.sub(r"[\W_]+", " ", (text or "").lower()).split()
        row = [f"{x} {y}" for x, y in zip(w, w[1:])]
        for n, b in sets.items():
            length, places = L.window_anchors(L.TEMPLATES[n], t)
            starts = {max(0, min(k - places[x], max(0, len(row) - length))) for k, x in enumerate(row) if x in places}
            good = {}
            for k in starts:
                a = set(row[k:k + length])
                d = 2 * len(a & b) / (len(a) + len(b))
                if d >= t:
                    good[k] = (d, a)
            out += [(i, -2, k, n, len(a & b), len(a), round(d, 9)) for k, (d, a) in good.items()
                    if not any(abs(o - k) < length and (e > d or (e == d and o < k)) for o, (e, _) in good.items())]
    return sorted(out, key=str)


def _got(df):
    return sorted(((r.id, r.line_no, r.first_word, r.template, r.shared, r.unit_bigrams, r.dice) for r in df.collect()), key=str)


def test_cases(spark):
    mit = L.TEMPLATES["MIT/text"]
    rows = [(1, None, "x"), (2, "", "x"), (3, "one", "x"), (4, "Released under the MIT License", "x"),
            (5, "intro\nReleased under  the *MIT* license!\nend", "x"), (6, mit, "x"), (7, "Copyright me\n\n" + mit.replace(". ", ".\n"), "x"),
            (8, "word " * 100000 + mit, "x"), (9, "Released under the mit", "x"), (9, "Licensed under CC BY-NC 4.0", "x"),
            (None, "Licensed under the Apache License, Version 2.0.\n\n", None), (10, "Released under the MIT License. " * 3, "x"),
            (11, "\n", "x"), (12, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, template string")
    got = _got(L.scan(docs))
    assert got == _want(rows)
    assert {r[0] for r in got} >= {4, 5, 6, 7, 8, 9, None, 10, 12}
    assert 100000 in [r[2] for r in got if r[0] == 8]


def test_wrapped_notices_inside_longer_texts(spark):
    """Notices over several lines above other text, in comments, and within a line."""
    def wrap(text, lead, width=60):
        lines, line = [], ""
        for w in text.split(" "):
            if len(line) + len(w) > width:
                lines.append(lead + line)
                line = ""
            line += (" " if line else "") + w
        return "\n".join([*lines, lead + line])
    code = "\n".join(f"value_{k} = compute({k}, other_{k})" for k in range(400))
    long = [n for n in L.TEMPLATES if n.split("/")[1] in ("header", "text", "notice")]
    rows = [(k, f"#!/bin/sh\n{wrap(L.TEMPLATES[n], '# ')}\n{code}", "x") for k, n in enumerate(long)]
    rows += [(50, f"We say: {L.TEMPLATES['MIT/project']} And we go on with many other words after it.", "x"),
             (51, code, "x"), (52, f"{code}\n{wrap(L.TEMPLATES['ISC/text'], '// ')}\n{code}\n{wrap(L.TEMPLATES['ISC/text'], '// ')}", "x")]
    got = _got(L.scan(spark.createDataFrame(rows, "doc_id long, text string, first_word string")))
    assert got == _want(rows)
    found = {(r[0], r[3]) for r in got if r[1] == -2}
    assert found >= {(k, n) for k, n in enumerate(long)} | {(50, "MIT/project"), (52, "ISC/text")}
    assert sum(r[0] == 52 for r in got) == 2 and not any(r[0] == 51 for r in got)


def test_empty_inputs(spark):
    docs = spark.createDataFrame([(1, "Released under the MIT License")], "doc_id long, text string")
    assert L.scan(docs.limit(0)).count() == 0
    assert L.scan(docs, templates={}).count() == 0


def test_documents_and_plan(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    df = L.op6_license_scan(spark, "/root/testdata/sf0.001")
    assert _got(df.withColumnRenamed("doc_id", "id")) == _want(rows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
