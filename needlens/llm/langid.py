"""Language identification by cross-parsing entropy (operator 5).

For each language a suffix automaton is built from a bounded sample of its
labelled texts.  A text is parsed greedily into the longest phrases that occur
in the language's sample; the language needing the fewest phrases per character
wins (Ziv-Merhav cross-parsing).

The automata are packed into one sparse table by row displacement: a state is the
offset of its row, rows overlap where their transitions leave room, and every
entry names its owner.  A step of the parse is one lookup; a transition that is
missing begins a new phrase at the language's root.  numpy follows all texts of a
slice and all languages at once, one character a step, over whole texts; the last
few long texts of a slice are followed one by one.  The table is broadcast.  Its
size follows the transitions (at most three a sampled character) and not the
alphabet: about 8 bytes each, so a few MB a language, plus 4 bytes for each
language and letter.

Training sample (the bound is ``ROWS_PER_LANG`` texts and ``CHARS_PER_LANG``
characters a language): the distinct labelled texts with the smallest hash, texts up
to ``ROW_CHARS`` characters first; longer ones are cut by the executors.

Defined results: a null text or one without letters is ``und`` with score 0.
Ties go to the language first in code point order.  ``score`` is
1 - best / second best phrase count; 1 if one language is learned.  Without any
labelled row every text is ``und``.  Extra columns are passed over or kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from needlens.llm.shared import batch_slices, packed, quoted, worker_state

ROWS_PER_LANG = 64
CHARS_PER_LANG = 40_000
ROW_CHARS = 8_000
SLICE = 4 << 20  # bytes of text parsed together, about
FEW = 32  # texts times languages, from which on texts are followed one by one
UNDETERMINED = "und"


# --- training ----------------------------------------------------------------

def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    trans, link, length, last = [{}], [-1], [0], 0
    for c in text:
        cur = len(trans)
        trans.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in trans[p]:
            trans[p][c] = cur
            p = link[p]
        if p != -1:
            q = trans[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(trans)
                trans.append(dict(trans[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and trans[p].get(c) == q:
                    trans[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return trans


def _letters(text: str) -> str:
    """Lower case; every run of other characters than letters is one blank."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def pack_rows(automata: list[list[dict[int, int]]], width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """One sparse table of all automata: entries (owner offset << 32 | next offset, -1
    if free), the root's targets of each automaton and class, and the offset of the
    state without transitions.  First the rows of several transitions go to the first
    place that fits, then single transitions fill the gaps."""
    free_from = width  # offsets below stay unused, so that no offset is negative
    slots: dict[int, tuple[int, int, int]] = {}
    owners, place = set(), {}
    rows = [(a, s) for a, trans in enumerate(automata) for s in range(1, len(trans)) if trans[s]]
    rows.sort(key=lambda r: -len(automata[r[0]][r[1]]))
    at = free_from
    for n, (a, s) in enumerate(rows):
        out = automata[a][s]
        if len(out) == 1:
            break
        first, tries = min(out), 0
        f = at
        while True:
            if f not in slots and f - first not in owners and all(f - first + c not in slots for c in out):
                break
            f, tries = f + 1, tries + 1
        if tries > 50:  # the table is dense here
            at = f - 25
        place[a, s] = f - first
        owners.add(f - first)
        for c, to in out.items():
            slots[f - first + c] = (a, s, to)
    else:
        n = len(rows)
    f = free_from
    for a, s in rows[n:]:  # a gap that does not suit the next transition is left
        (c, to), = automata[a][s].items()
        while f in slots or f - c in owners:
            f += 1
        place[a, s] = f - c
        owners.add(f - c)
        slots[f] = (a, s, to)
    dead = max(slots, default=free_from) + 1
    table = np.full(dead + width, -1, np.int64)
    for f, (a, s, to) in slots.items():
        table[f] = place[a, s] << 32 | place.get((a, to), dead)
    roots = np.full((len(automata), width), dead, np.int32)
    for a, trans in enumerate(automata):
        for c, to in trans[0].items():
            roots[a, c] = place.get((a, to), dead)
    return table, roots, dead


def train(samples: dict[str, list[str]], chars: int = CHARS_PER_LANG) -> dict:
    """Model: languages, code point classes and the packed automata.

    Class 0 is the blank, then the learned letters, the last class any other letter.
    """
    langs = sorted(samples)
    texts = [(" ".join(_letters(t) for t in samples[g]))[:chars] for g in langs]
    alphabet = sorted(set("".join(texts)) - {" "})
    width = len(alphabet) + 2
    kind = np.uint8 if width <= 256 else np.uint16 if width <= 65536 else np.int32
    classes = np.zeros(0x110000, kind)
    for cp in range(0x110000):
        if chr(cp).isalpha():
            classes[cp] = width - 1
    code = {" ": 0}
    for k, c in enumerate(alphabet, 1):
        code[c] = classes[ord(c)] = k
    table, roots, dead = pack_rows([suffix_automaton([code[c] for c in t]) for t in texts], width)
    return {"langs": langs, "classes": classes, "table": table, "roots": roots, "dead": dead}


def sample(docs: DataFrame, labelled: Column, id_col: str, text_col: str, lang_col: str,
           rows_per_lang: int = ROWS_PER_LANG, chars: int = CHARS_PER_LANG) -> dict[str, list[str]]:
    """The bounded training sample, read on the driver.  The hashes are chosen first,
    so the copies of one text count once and other texts are not moved."""
    text, lang = F.col(quoted(text_col)), F.col(quoted(lang_col))
    rows = docs.where(labelled & lang.isNotNull() & text.rlike(r"\p{L}")).select(
        lang.alias("lang"), (F.length(text) > ROW_CHARS).alias("long"), F.xxhash64(text).alias("h"),
        F.substring(text, 1, chars).alias("text"))
    w = Window.partitionBy("lang").orderBy("long", "h")
    top = rows.select("lang", "long", "h").distinct().withColumn("r", F.row_number().over(w)).where(F.col("r") <= rows_per_lang)
    chosen = docs.sparkSession.createDataFrame(top.collect(), top.schema)  # rows_per_lang rows a language
    got = rows.join(F.broadcast(chosen), ["lang", "long", "h"]).groupBy("lang", "r").agg(F.min("text").alias("text"))
    out: dict[str, list[str]] = {}
    for r in got.orderBy("lang", "r").toLocalIterator():
        out.setdefault(r["lang"], []).append(r["text"])
    return out


# --- prediction ----------------------------------------------------------------

def phrase_counts(texts: list[str], model: dict) -> np.ndarray:
    """Phrases of every whole text in every language; 0 for a text without letters."""
    table, roots, classes = model["table"], model["roots"], model["classes"]
    n, langs = len(texts), len(model["langs"])
    out = np.zeros((n, langs), np.int64)
    if not n or not langs:
        return out
    low = [t.lower() for t in texts]
    code = classes[np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), "<u4")]
    stops = np.cumsum([len(t) + 1 for t in low])
    keep = np.ones(len(code), bool)  # drop all but one blank of a run, and those at either end
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
    keep[0] = code[0] != 0
    kept = np.concatenate((np.zeros(1, np.int32), np.cumsum(keep, dtype=np.int32)))
    code = code[keep]
    begin, end = kept[np.concatenate(([0], stops[:-1]))], kept[stops]
    # a text's last kept code may be a blank: the separator, or its own last run
    begin = begin + ((begin < end) & (code[np.minimum(begin, len(code) - 1)] == 0) if len(code) else 0)
    size = end - begin
    if len(code):
        size = size - ((size > 0) & (code[np.maximum(end - 1, 0)] == 0))
    order = np.argsort(-size, kind="stable")
    size, begin = size[order], begin[order]
    state = np.full((langs, n), model["dead"], np.int64)
    count = np.zeros((langs, n), np.int64)
    span, at, some = 512, 0, int(np.count_nonzero(size))
    few = FEW // langs
    while at < int(size[0]):
        live = int(np.searchsorted(-size, -at, side="left"))  # texts longer than `at`
        if live <= few:
            break
        steps = np.arange(at, min(at + span, int(size[0])))
        block = code[np.minimum(begin[:live, None] + steps, len(code) - 1)]
        block = np.ascontiguousarray(block.T).astype(np.int64)
        for row, m in zip(block, np.searchsorted(-size[:live], -steps, side="left").tolist()):
            s, c = state[:, :m], row[:m]
            to = table.take(s + c) - (s << 32)  # within 32 bits if the entry is the state's own
            own = to.view(np.uint64) < _OWN
            state[:, :m] = np.where(own, to, roots[:, c])
            count[:, :m] += ~own
        at += len(steps)
    for i in range(min(few, some)):
        if size[i] > at:
            rest = code[begin[i] + at:begin[i] + size[i]].tolist()
            for g in range(langs):
                count[g, i] += _follow(rest, int(state[g, i]), memoryview(table), roots[g].tolist())
    out[order] = count.T
    return out


_OWN = np.uint64(1 << 32)


def _follow(codes: list[int], s: int, table, root: list[int]) -> int:
    """Phrases that begin in ``codes``, from state ``s`` on."""
    n = 0
    for c in codes:
        to = table[s + c]
        if to >> 32 == s:
            s = to & 0xFFFFFFFF
        else:
            s, n = root[c], n + 1
    return n


def predict(texts: list[str], model: dict) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language and score of whole texts that are parsed together, and whether a
    language is told at all."""
    langs = model["langs"]
    counts = phrase_counts(texts, model)
    if not langs or not texts:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
    best = counts.argmin(1)
    two = np.sort(counts, axis=1)[:, :2].astype(float)
    some = two[:, 0] > 0
    score = np.ones(len(texts)) if len(langs) == 1 else 1 - two[:, 0] / np.maximum(two[:, -1], 1)
    return [langs[b] if k else UNDETERMINED for b, k in zip(best, some)], np.where(some, score, 0.0), some


def detect(rows: DataFrame, model: dict) -> DataFrame:
    """``row, lang_pred, score, known`` for rows (row, text); ``known`` is false for
    texts without letters, whatever the languages are called."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        worker_state("langid")
        for b in batch_slices(batches, "text", SLICE):
            langs, score, known = predict([t or "" for t in b.column("text").to_pylist()], shared.value)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(known)],
                ["row", "lang_pred", "score", "known"])
    return rows.mapInArrow(run, StructType([
        rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType()),
        StructField("known", BooleanType())]))


def held_out(id_col: str = "doc_id") -> Column:
    """Remainder 0 of the id's checksum; a null id is neither held out nor learned from."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    return train(sample(docs, ~held_out(id_col), id_col, text_col, lang_col))


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language can be told; all columns unchanged."""
    model = fit(docs, id_col, text_col, lang_col)
    return detect(packed(docs, F.col(quoted(text_col)).alias("text")), model).where("known").select("row.*")


def op5_language_id(spark, sf_dir):
    """Contract query: the predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select(F.struct("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out")).alias("row"), "text")
    return detect(rows, fit(docs)).select("row.doc_id", "row.held_out", "lang_pred", "score")
