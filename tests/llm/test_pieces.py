import itertools
import random

import public_tokenizers as P
import pytest
import sentencepiece

from needlens.llm import pieces as S

PATH = P.path("piece_bpe_32k.model")
VOCABULARY = S.load_vocabulary(PATH)


@pytest.fixture(scope="module")
def as_unigram():
    """The library with the same pieces and scores under its own Viterbi."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(open(PATH, "rb").read())
    m.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    for p in m.pieces:  # scores that sums in single precision keep exactly
        p.score = max(p.score, -40000.0)
    return sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())


def test_same_as_library(as_unigram, spark):
    v = {**VOCABULARY, "scores": [max(s, -40000.0) for s in VOCABULARY["scores"]]}
    enc, dec = S.Encoder(v, limit=50), S.Decoder(v)
    texts = ["", " ", "a", "  two  blanks ", "Hello, world. It's 12,500!", "tab\tand\nline\r\n end", "naïve été ß 漢字 \U0001F600 ok",
             "x" * 300, ".,;:!? . , a.b.c,d", "\n\n \n"]
    texts += [r.text[:400] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    for t in texts:
        assert enc.encode(t).tolist() == as_unigram.encode(t), t
        assert dec.decode(enc.encode(t).tolist()) == t
        assert dec.decode(as_unigram.encode(t)) == as_unigram.decode(as_unigram.encode(t))


def test_best_score_by_brute_force():
    rnd = random.Random(2)
    words = ["a", "b", "ab", "ba", "aab", "bb", S.MARK, S.MARK + "a", S.MARK + "ab", "c", "."]
    v = {"pieces": ["<unk>", *words], "scores": [0.0, *[-float(rnd.randint(1, 9)) for _ in words]],
         "bytes": [], "other": [0], "unknown": 0}
    enc = S.Encoder(v)
    score = dict(zip(words, v["scores"][1:]))
    for _ in range(200):
        t = "".join(rnd.choice("ab .ac") for _ in range(rnd.randint(1, 9)))
        s = S.MARK + t.replace(" ", S.MARK)
        best = None
        for cut in itertools.product((0, 1), repeat=len(s) - 1):
            parts, last = [], 0
            for k, c in enumerate(cut, 1):
                if c:
                    parts.append(s[last:k])
                    last = k
            parts.append(s[last:])
            if all(p in score for p in parts):
                total = sum(score[p] for p in parts)
                best = total if best is None else max(best, total)
        got = [v["pieces"][i] for i in enc.encode(t)]
        assert "".join(got) == s and sum(score[p] for p in got) == best


def test_dataframe(spark):
    rows = [(1, None, [1]), (2, "", [1]), (3, "long text é " * 20000, None), (4, "same", [2]), (4, "same", [2]), (None, "漢\U0001F600", [3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece_ids array<int>")
    got = S.encode(docs, PATH, check=True)
    assert got.columns == ["doc_id", "n_pieces", "piece_ids", "round_trip"]
    back = S.decode(got, PATH)
    key = lambda r: (r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=key) == sorted([r[:2] for r in rows], key=key)
    assert {r.round_trip for r in got.collect()} == {None, True}
    assert all(r.n_pieces == len(r.piece_ids) for r in got.collect() if r.n_pieces is not None)
    assert S.encode(docs.limit(0), PATH).count() == 0
    whole = S.op2_sentencepiece(spark, "/root/testdata/sf0.001")
    assert whole.where("round_trip").count() == whole.count() == 200
