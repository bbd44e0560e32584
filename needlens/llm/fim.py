"""Fill-in-middle transformation by a learned rank index (operator 12).

A text is cut into units (code points, words or lines) and rearranged around two
cuts.  Cuts are given as ranks of unit boundaries, output is made of bytes, so
every cut asks: at which byte does the r-th unit begin?  The texts of a slice are
laid end to end and a piecewise-linear index over all their boundary offsets
answers:

* segments are fitted with a bounded error by a shrinking cone (each point leaves
  the range of slopes that keep all points so far within ``ERROR`` bytes; the
  segment ends where the range is empty);
* the residual of every boundary against its segment is stored (one byte each);
* a cut is predicted from its segment, then corrected exactly by its residual.

The hash of a document's id gives its form and its cuts, so reruns agree and
rows need not be shuffled: one pass over whole texts.

Output of a document: ``plain`` text; ``psm`` ``<P>prefix<S>suffix<M>middle``;
``spm`` ``<S>suffix<P>prefix<M>middle``.  ``restored`` rebuilds the text; that is
exact because texts which contain a mark stay plain.

Defined results: a null text counts as empty and is plain.  A null id is hashed
as the empty string; rows that repeat an id share their hashes.  Extra columns
are passed over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from needlens.llm.shared import text_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
RATE = 90  # of 100 texts, cut
SPM = 20  # of 100 cut texts, suffix first
ERROR = 120  # bytes that a predicted boundary may be off
SLICE = 1 << 20  # bytes indexed together, about
SCHEMA = "id long, n long, form string, prefix_units long, middle_units long, output string"


# --- the rank index --------------------------------------------------------------

class RankIndex:
    """Offset of the r-th boundary of a rising sequence: segments and residuals."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR):
        first, slope = fit_segments(offsets, error)
        self.first, self.base, self.slope = first, offsets[first], slope
        rank = np.arange(len(offsets))
        seg = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(offsets))))
        residual = offsets - self.predict(rank, seg)
        if len(residual) and np.abs(residual).max() > error + 1:
            raise AssertionError("a segment misses its error bound")
        self.residual = residual.astype(np.int8 if error < 127 else np.int32)

    def predict(self, rank: np.ndarray, seg: np.ndarray) -> np.ndarray:
        return self.base[seg] + np.rint(self.slope[seg] * (rank - self.first[seg])).astype(np.int64)

    def offset(self, rank: np.ndarray) -> np.ndarray:
        """Exact offsets of boundaries: predicted, then corrected."""
        seg = np.searchsorted(self.first, rank, side="right") - 1
        return self.predict(rank, seg) + self.residual[rank]


def fit_segments(offsets: np.ndarray, error: int) -> tuple[np.ndarray, np.ndarray]:
    """First ranks and slopes of segments that keep every offset within ``error``."""
    n, at, step, first, slope = len(offsets), 0, 256, [], []
    while at < n:
        low, high, end, size = -np.inf, np.inf, at + 1, step
        while end < n:
            run = np.arange(end - at, min(end + size, n) - at)
            rise = (offsets[end:end + size] - offsets[at]).astype(np.float64)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            stays = len(run) if lows[-1] <= highs[-1] else int(np.argmax(lows > highs))
            if stays:
                low, high = lows[stays - 1], highs[stays - 1]
            end += stays
            if stays < len(run):
                break
            size = min(2 * size, 1 << 16)
        first.append(at)
        slope.append((low + high) / 2 if end > at + 1 else 0.0)
        step = min(max(256, 1 << (end - at).bit_length() - 1), 1 << 16)
        at = end
    return np.array(first, np.int64), np.array(slope)


# --- units ------------------------------------------------------------------------

def boundaries(raw: np.ndarray, starts: np.ndarray, unit: str) -> np.ndarray:
    """Offsets in the UTF-8 bytes ``raw`` at which a unit begins.  ``starts``: the
    first bytes of the texts that are not empty."""
    if unit == "code point":
        return np.flatnonzero((raw & 0xC0) != 0x80)
    begins = np.zeros(len(raw), bool)
    if unit == "line":
        begins[1:] = raw[:-1] == 10
    elif unit == "word":  # a word and the blanks after it
        blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
        begins[1:] = blank[:-1] & ~blank[1:]
    else:
        raise ValueError(f"unknown unit {unit!r}")
    begins[starts] = True
    return np.flatnonzero(begins)


def _cutter(unit, rate, spm, marks, error, size):
    p, s, m = (x.encode() for x in marks)

    def run(batches):
        for ids, hashes, raw, ends in text_slices(batches, "text", ("id", "h"), size):
            begins = np.concatenate(([0], ends[:-1]))
            at = boundaries(raw, begins[ends > begins], unit)
            index = RankIndex(np.append(at, len(raw)), error)
            base = np.searchsorted(at, begins)
            n = np.searchsorted(at, ends) - base
            h = np.array(hashes.to_pylist(), np.int64).reshape(-1, 4)
            one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
            low, high = np.minimum(one, two), np.maximum(one, two)
            cut_a, cut_b = index.offset(base + low), index.offset(base + high)
            data, out, form = raw.tobytes(), [], []
            for i, (x, a, b, y) in enumerate(zip(begins.tolist(), cut_a.tolist(), cut_b.tolist(), ends.tolist())):
                text = data[x:y]
                if not text or h[i, 2] % 100 >= rate or p in text or s in text or m in text:
                    form.append("plain")
                    out.append(text)
                elif h[i, 3] % 100 < spm:
                    form.append("spm")
                    out.append(b"".join((s, data[b:y], p, data[x:a], m, data[a:b])))
                else:
                    form.append("psm")
                    out.append(b"".join((p, data[x:a], s, data[b:y], m, data[a:b])))
            plain = np.array([f == "plain" for f in form], bool)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(low, pa.int64(), mask=plain),
                 pa.array(high - low, pa.int64(), mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
                ["id", "n", "form", "prefix_units", "middle_units", "output"])
    return run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "code point",
                   seed: int = SEED, rate: int = RATE, spm: int = SPM, marks=(PREFIX, SUFFIX, MIDDLE),
                   error: int = ERROR) -> DataFrame:
    """``id, n, form, prefix_units, middle_units, output`` of every document.  ``n``
    counts the units; the two lengths are null for plain texts."""
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    parts = F.array(*(F.conv(F.substring(F.col("hexed"), 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)))
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                        hexed.alias("hexed"))
                .select("id", "text", parts.alias("h")))
    return rows.mapInArrow(_cutter(unit, rate, spm, marks, error, SLICE), SCHEMA)


def restored(output: Column, form: Column, marks=(PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output was made from."""
    p, s, m = (F.lit(x) for x in marks)

    def tail(c, first):  # without the leading mark
        return F.substr(c, F.lit(len(first) + 1))
    rest = F.split_part(output, s, F.lit(2))
    psm = F.concat(tail(F.split_part(output, s, F.lit(1)), marks[0]), F.split_part(rest, m, F.lit(2)),
                   F.split_part(rest, m, F.lit(1)))
    after = F.split_part(output, p, F.lit(2))
    spm = F.concat(F.split_part(after, m, F.lit(1)), F.split_part(after, m, F.lit(2)),
                   tail(F.split_part(output, p, F.lit(1)), marks[1]))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark, sf_dir):
    """Contract query: form, cuts and digests of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = fill_in_middle(docs)
    return out.select(F.col("id").alias("doc_id"), "n", "form", F.col("prefix_units").alias("prefix_chars"),
                      F.col("middle_units").alias("middle_chars"),
                      F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


OP12_SQL = f"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s
  FROM documents
), c AS (
  SELECT doc_id, t, n, CAST('0x' || s[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || s[9:16] AS BIGINT) % (n + 1) AS b,
         CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}')
                   OR CAST('0x' || s[17:24] AS BIGINT) % 100 >= {RATE} THEN 'plain'
              WHEN CAST('0x' || s[25:32] AS BIGINT) % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT doc_id, t, n, form, least(a, b) AS lo, greatest(a, b) AS hi,
         substring(t, 1, least(a, b)) AS x, substring(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS m,
         substring(t, greatest(a, b) + 1) AS y
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(lo AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(hi - lo AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || x || '{SUFFIX}' || y || '{MIDDLE}' || m
              ELSE '{SUFFIX}' || y || '{PREFIX}' || x || '{MIDDLE}' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""
