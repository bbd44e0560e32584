import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from needlens.llm import fim as Z


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _want(i, text):
    text = text or ""
    n, s = len(text), _sha(f"1:{'' if i is None else i}")
    h = [int(s[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (str(i), n, "plain", None, None, _sha(text), _sha(text))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return (str(i), n, "spm", a, b - a, _sha(f"<S>{suf}<P>{pre}<M>{mid}"), _sha(text))
    return (str(i), n, "psm", a, b - a, _sha(f"<P>{pre}<S>{suf}<M>{mid}"), _sha(text))


def _rows():
    rng = np.random.default_rng(3)
    texts = [None, "", "a", "é", "中文", "👍🏽 ok", "<P>", "x<S>y", "a <M> b", "< P>", "<P", "S>", "\n\n", " ", "a\0b",
             "word " * 4000, "漢字" * 9000, "a漢" * 7000, "x" * 70000 + "é" * 70000, "abc", "abc", "abc<", ">abc"]
    letters = list("ab <>PSM/é漢👍\n")
    texts += ["".join(rng.choice(letters, int(rng.integers(0, 60)))) for _ in range(300)]
    rows = list(enumerate(texts))
    return rows + [(5, "again"), (5, "again"), (None, "no id"), (-3, "negative")]


@pytest.mark.parametrize("size", [1 << 20, 64])
def test_cases(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(Z, "SLICE", size)
    rows = _rows()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, form string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = [(str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256)
           for r in Z.op12_fill_in_middle(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((_want(i, t) for i, t in rows), key=str)
    assert {g[2] for g in got} == {"plain", "psm", "spm"}
    assert Z.fill_in_middle(df.limit(0)).count() == 0


def test_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = [(str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256)
           for r in Z.op12_fill_in_middle(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got, key=str) == sorted((_want(r.doc_id, r.text) for r in rows), key=str)


@pytest.mark.parametrize("unit", ["word", "line"])
def test_other_units_cut_at_their_boundaries(spark, unit):
    texts = ["one two  three\nfour", "", None, "  lead and\ttrail  ", "\na\n\nb", "single", "漢字 かな\n次"]
    df = spark.createDataFrame(list(enumerate(texts * 20)), "doc_id long, text string")
    for r in Z.fill_in_middle(df, unit=unit, rate=100).where("form = 'psm'").collect():
        text = (texts * 20)[r.id]
        pre, rest = r.output[3:].split("<S>")
        suf, mid = rest.split("<M>")
        assert pre + mid + suf == text
        for cut in (pre, pre + mid):
            if 0 < len(cut) < len(text):
                assert cut[-1] == "\n" if unit == "line" else cut[-1].isspace() and not text[len(cut)].isspace()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=800), st.integers(0, 120))
def test_rank_index_is_exact_and_bounded(steps, error):
    offsets = np.concatenate(([0], np.cumsum(np.array(steps, np.int64))))
    index = Z.RankIndex(offsets, error)
    rank = np.arange(len(offsets))
    assert (index.offset(rank) == offsets).all()
    assert np.abs(index.residual).max(initial=0) <= error + 1


def test_rank_index_needs_few_segments():
    rng = np.random.default_rng(1)
    steps = np.concatenate((np.ones(200_000, np.int64), np.full(100_000, 3), rng.integers(1, 4, 100_000)))
    offsets = np.concatenate(([0], np.cumsum(steps)))
    index = Z.RankIndex(offsets)
    assert (index.offset(np.arange(len(offsets))) == offsets).all()
    assert len(index.first) < 60
