import random

import numpy as np
import pytest
from pyspark.sql import Row

from strandline.llm import sentencepiece_codec as sp


@pytest.fixture(scope="module")
def codec():
    return sp.Codec(sp.PieceTable.load(sp.default_model()))


def brute(table, text):
    """Plain dynamic programming over all substrings, without units or automaton."""
    score = {p: (s, i) for i, (p, s, k) in enumerate(table.pieces) if k == 1}
    byte = {int(p[1:-1], 16): i for i, (p, _, k) in enumerate(table.pieces) if k == 6}
    low = min(s for s, _ in score.values()) - sp.UNKNOWN_PENALTY
    text = sp.MARK + text.replace(" ", sp.MARK)
    best = [(0.0, None)] + [(float("-inf"), None)] * len(text)
    longest = max(map(len, score))
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - longest), end):
            piece = text[start:end]
            value = score[piece][0] if piece in score else low if end - start == 1 else None
            if value is not None and best[start][0] + value > best[end][0]:
                best[end] = (best[start][0] + value, (start, piece))
    out, at = [], len(text)
    while at:
        start, piece = best[at][1]
        out = ([score[piece][1]] if piece in score else [byte[b] for b in piece.encode()]) + out
        at = start
    return out


def test_matches_plain_dynamic_programming(codec):
    table = sp.PieceTable.load(sp.default_model())
    rng = random.Random(1)
    texts = ["a", " ", "  x", "x  ", "the and the,\nof\n\nit", "größe 中文 \U0001f600 end", "\t\x00", "AKIA12 ... --- ==="]
    texts += ["".join(rng.choice("thean oi,.\nsé中ß") for _ in range(rng.randint(1, 60))) for _ in range(150)]
    for t in texts:
        assert np.frombuffer(codec.encode(t), "<i4").tolist() == brute(table, t), t


def test_round_trip_of_odd_rows(spark):
    texts = [None, "", " ", "\n", "a  b ", "x" * 20000, "é中\U0001f600", "▁"]
    docs = spark.createDataFrame([Row(doc_id=i, text=t, ids=[9], extra=1) for i, t in enumerate(texts)] * 2, "doc_id long, text string, ids array<int>, extra int")
    rows = sp.round_trip(docs, sp.default_model()).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        assert r.exact == (texts[r.doc_id] != "▁")
        assert (r.n_pieces == 0) == (not texts[r.doc_id])
    assert sp.round_trip(docs.limit(0), sp.default_model()).count() == 0


def test_one_function_gives_what_encoding_and_decoding_give(spark):
    texts = [None, "", "a  b ", "größe \U0001f600\n\n▁ end", "the and the"]
    docs = spark.createDataFrame([Row(doc_id=i, text=t, _pieces=1, ids=[9]) for i, t in enumerate(texts)], "doc_id long, text string, _pieces int, ids array<int>")
    apart = sp.decode(sp.encode(docs, sp.default_model()), sp.default_model())
    both = sp.encode_decode(docs, sp.default_model())
    assert both.columns == apart.columns
    assert sorted(both.collect()) == sorted(apart.collect())


def test_decoding_bytes_that_are_not_text(spark, codec):
    ids = [codec.bytes_id[0xFF], codec.bytes_id[0x41]]
    assert codec.decode(ids) == "�A"
    got = sp.decode(spark.createDataFrame([(ids,), (None,), ([],)], "ids array<int>"), sp.default_model()).collect()
    assert [r.decoded for r in got] == ["�A", None, ""]


def test_equals_the_library_where_scores_are_exact_in_its_floats(spark, codec):
    """The library adds 32-bit floats: the model's scores of -1e9 cost it a precision of 64, so they are raised on its side."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(sp.default_model(), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    for piece in model.pieces:
        piece.score = max(piece.score, -40000.0)
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text IS NOT NULL").collect()]
    words = sorted({w for t in texts for w in t.split()})
    assert len(words) > 1000
    assert [w for w in words if np.frombuffer(codec.encode(w), "<i4").tolist() != library.encode(w)] == []
