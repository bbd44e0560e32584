"""SentencePiece encoding and decoding by Viterbi (operator 2).

An Aho-Corasick automaton holds all pieces of a vocabulary.  One pass over a
text follows its output links at each position and relaxes the best score of
the position; the best path is read back.  The score of a segmentation is the
sum of its pieces' scores; ties go to the longer last piece.  Characters that
no piece covers are spelled in byte pieces (or the unknown piece without them).

No piece of a SentencePiece vocabulary crosses from a character to a following
blank mark, so the best path of a text is the best paths of its blank-led cuts
laid end to end.  This is verified on the vocabulary when it is loaded, as is the
cut between a letter and a following full stop or comma; only boundaries that no
piece crosses are used.  Equal cuts are solved once per worker (the cache is
emptied at ``CACHE_BYTES``, long cuts are not kept), whole texts are processed.

Text is taken as it is (identity normalisation); a blank becomes the mark
U+2581 and a leading mark is added, and removed again in decoding.

Defined results: null text gives null ids and decodes to null; empty text gives
no ids.  A text that holds the mark itself decodes to a blank there.
"""

from __future__ import annotations

import re
import zlib
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from needlens.llm.shared import batch_slices, quoted, worker_state

MARK = "▁"
CACHE_BYTES = 32 << 20  # of cuts and their ids kept by a worker
UNKNOWN_PENALTY = 10.0


def load_vocabulary(path: str) -> dict:
    """Pieces, scores and kinds of a ``.model`` file, as plain data."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    n = p.vocab_size()
    return {"pieces": [p.id_to_piece(i) for i in range(n)], "scores": [p.get_score(i) for i in range(n)],
            "bytes": [i for i in range(n) if p.is_byte(i)],
            "other": [i for i in range(n) if p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i)],
            "unknown": p.unk_id()}


class Encoder(dict):
    """Ids of a cut as packed bytes, computed on first use."""

    def __init__(self, vocabulary: dict, limit: int = CACHE_BYTES):
        import ahocorasick

        super().__init__()
        pieces, scores, skip = vocabulary["pieces"], vocabulary["scores"], set(vocabulary["other"])
        self.automaton, self.limit, self.held = ahocorasick.Automaton(), limit, 0
        normal = [i for i in range(len(pieces)) if i not in skip]
        for i in normal:
            self.automaton.add_word(pieces[i], (len(pieces[i]), scores[i], i))
        self.automaton.make_automaton()
        self.single = {pieces[i] for i in normal if len(pieces[i]) == 1}
        low = min((scores[i] for i in normal), default=0.0)
        self.unknown_score, self.unknown = low - UNKNOWN_PENALTY, vocabulary["unknown"]
        self.spelled = {int(pieces[i][3:5], 16): i for i in vocabulary["bytes"]}
        self.dtype = np.dtype("<u2" if len(pieces) <= 1 << 16 else "<u4")
        # boundaries that no piece crosses
        crossed = {a + b for i in normal for a, b in zip(pieces[i], pieces[i][1:])}
        if any(c[1] == MARK and c[0] != MARK for c in crossed):
            self.cut = re.compile(r"(?s).+")
        else:
            loose = "".join(c for c in "\n\t\r" if not any(c in pair for pair in crossed) and c not in self.single)
            body = f"[^{MARK}{re.escape(loose)}]" if loose else f"[^{MARK}]"
            self.cut = re.compile(f"{MARK}*{body}+|{MARK}+|[{re.escape(loose)}]" if loose else f"(?s){MARK}*{body}+|{MARK}+")
        letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
        self.marks = {m for m in ".,;:!?" if not any(c + m in crossed for c in letters)}
        self.letters = frozenset(letters)

    def solve(self, cut: str) -> list[int]:
        """The best path of a cut: one pass of the automaton with relaxation."""
        n = len(cut)
        best, back = [0.0] + [None] * n, [None] * (n + 1)
        found = self.automaton.iter(cut)
        at, hit = 0, next(found, None)
        for end in range(1, n + 1):
            while hit is not None and hit[0] == end - 1:  # longest piece first
                size, score, i = hit[1]
                score += best[end - size]
                if best[end] is None or score > best[end]:
                    best[end], back[end] = score, (end - size, i)
                hit = next(found, None)
            if cut[end - 1] not in self.single:
                score = best[end - 1] + self.unknown_score
                if best[end] is None or score > best[end]:
                    best[end], back[end] = score, (end - 1, None)
        path, at = [], n
        while at:
            start, i = back[at]
            if i is None:
                raw = cut[start:at].encode("utf-8", "surrogatepass")
                path.extend([self.spelled[b] for b in reversed(raw)] if self.spelled else [self.unknown])
            else:
                path.append(i)
            at = start
        path.reverse()
        return path

    def __missing__(self, cut):
        if len(cut) > 1 and cut[-1] in self.marks and cut[-2] in self.letters:
            ids = self[cut[:-1]] + self[cut[-1]]
        else:
            ids = np.array(self.solve(cut), self.dtype).tobytes()
        size = getsizeof(cut) + getsizeof(ids) + 100
        if self.held + size > self.limit:
            self.clear()
            self.held = 0
        if size <= self.limit // 64:
            self.held += size
            self[cut] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, self.dtype)
        cuts = self.cut.findall(MARK + text.replace(" ", MARK))
        return np.frombuffer(b"".join(map(self.__getitem__, cuts)), self.dtype)


class Decoder:
    def __init__(self, vocabulary: dict):
        pieces = [p.replace(MARK, " ").encode() for p in vocabulary["pieces"]]
        for i in vocabulary["other"]:
            pieces[i] = b""
        pieces[vocabulary["unknown"]] = " ⁇ ".encode()
        for i in vocabulary["bytes"]:
            pieces[i] = bytes([int(vocabulary["pieces"][i][3:5], 16)])
        self.pieces = pieces

    def decode(self, ids) -> str:
        raw = b"".join(map(self.pieces.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def _model(shared) -> tuple[Encoder, Decoder]:
    state, key = worker_state("pieces"), ("pieces", shared.value["key"])
    if key not in state:
        state[key] = (Encoder(shared.value), Decoder(shared.value))
    return state[key]


def _share(spark, path):
    v = load_vocabulary(path)
    v["key"] = zlib.crc32(repr((v["pieces"], v["scores"])).encode())
    return spark.sparkContext.broadcast(v)  # bounded by the vocabulary file


def _lists(rows) -> pa.ListArray:
    """Arrow lists of ids from packed arrays; None stays null."""
    ends = np.cumsum([0 if r is None else len(r) for r in rows], dtype=np.int64)
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    values = np.concatenate([r for r in rows if r is not None] or [np.zeros(0)]).astype(np.int32)
    got = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
    missing = np.array([r is None for r in rows], bool)
    if missing.any():
        got = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array(missing))
    return got


SLICE = 1 << 21  # bytes of text encoded at once, about
RESULTS = ("n_pieces", "piece_ids", "round_trip")


def _encode_batches(shared, check):
    def run(batches):
        enc, dec = _model(shared)
        for b in batch_slices(batches, "text", SLICE):
            texts = b.column("text").to_pylist()
            ids = [None if t is None else enc.encode(t) for t in texts]
            columns = [b.column("row"), pa.array([None if i is None else len(i) for i in ids], pa.int64()), _lists(ids)]
            if check:
                same = [None if t is None else dec.decode(i.tolist()) == t.replace(MARK, " ")
                        for t, i in zip(texts, ids)]
                columns.append(pa.array(same, pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, ["row", *RESULTS][:len(columns)])
    return run


def encode(docs: DataFrame, model: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
           check: bool = False) -> DataFrame:
    """``keep`` columns with ``n_pieces`` and ``piece_ids`` of each whole text;
    ``check`` adds whether decoding the ids gives the text back.  The results replace
    columns of ``keep`` of their names."""
    results = RESULTS if check else RESULTS[:2]
    keep = [c for c in keep if c not in results]
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in keep] or [F.lit(0).alias("none")]).alias("row"),
                       F.col(quoted(text_col)).cast("string").alias("text"))
    schema = StructType([rows.schema["row"], *(StructField(c, t) for c, t in zip(
        results, (LongType(), ArrayType(IntegerType()), BooleanType())))])
    out = rows.mapInArrow(_encode_batches(_share(docs.sparkSession, model), check), schema)
    return out.select(*[F.col(f"row.{quoted(c)}").alias(c) for c in keep], *results)


def decode(encoded: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id",), ids_col: str = "piece_ids") -> DataFrame:
    """``keep`` columns with the decoded ``text``."""
    shared = _share(encoded.sparkSession, model)

    def run(batches):
        dec = _model(shared)[1]
        for b in batches:
            texts = [None if x is None else dec.decode(x) for x in b.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(texts, pa.string())],
                                             [*keep, "text"])

    rows = encoded.select(*keep, F.col(ids_col).alias("_ids"))
    kinds = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, kinds + ", text string")


def op2_sentencepiece(spark, sf_dir):
    """Pieces of every document, and whether they decode to its text."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, public_tokenizers.path("piece_bpe_32k.model"), check=True)
