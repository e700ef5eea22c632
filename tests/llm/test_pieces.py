from zlib import crc32

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from skyledger.llm import pieces_bpe as pb

from .fixtures import DOC, awkward_docs

SF = "/root/testdata/sf0.001"
TEXTS = ["Hello  world", " a   b ", "x\n\ny  \n z", "été 日本 𝔘 ▁mark▁", "a\tb\r\n", "   ", "\n", "tokenization " * 30, "aaaaaaaaaaaaaaaaaaaaaaaa", "\x00\x7f"]


@pytest.fixture(scope="module")
def vocabulary():
    return pb.Vocabulary(pb.MODEL_FILE)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pb.MODEL_FILE)


def test_without_dropout_the_library_agrees(vocabulary, library, spark):
    encoder = pb.Encoder(vocabulary, 0.0, 0, 4)
    for text in [t for t in TEXTS if "▁" not in t and "\x00" not in t]:
        assert encoder.encode(text, 1) == library.encode(text), text
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(40).collect():
        assert encoder.encode(r.text, 1) == library.encode(r.text)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 0.99])
def test_every_text_decodes(vocabulary, dropout):
    encoder = pb.Encoder(vocabulary, dropout, 3, 4)
    for text in TEXTS:
        for key in range(5):
            assert pb.decode(encoder.encode(text, key), vocabulary) == text


def test_dropout_varies_and_repeats(vocabulary):
    text = "internationalization of misunderstandings " * 20
    few = len(pb.Encoder(vocabulary, 0.0, 1, 4).encode(text, 7))
    a, b = (pb.Encoder(vocabulary, 0.1, 1, 4).encode(text, 7) for _ in range(2))
    assert a == b and len(a) > few
    assert a != pb.Encoder(vocabulary, 0.1, 2, 4).encode(text, 7) and a != pb.Encoder(vocabulary, 0.1, 1, 4).encode(text, 8)
    lengths = [len(pb.Encoder(vocabulary, d, 1, 4).encode(text, 7)) for d in (0.0, 0.1, 0.3, 0.6, 0.95)]
    assert lengths == sorted(lengths)
    assert lengths[-1] <= len(text) + 1


def test_many_at_once_equals_one_by_one(vocabulary, spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(6).collect()] + TEXTS
    for dropout in (0.0, 0.1, 0.6):
        encoder = pb.Encoder(vocabulary, dropout, 11, 3)
        for text in texts:
            for chunk in set(pb._CHUNK.findall(" " + text)):
                for v in range(3):
                    encoder._learn([chunk], v)
                    assert np.frombuffer(encoder.known[v][chunk], np.int32).tolist() == list(encoder._segment(chunk, v)), chunk
        together = pb.Encoder(vocabulary, dropout, 11, 3).encode_all(texts, list(range(len(texts))))
        assert together == [pb.Encoder(vocabulary, dropout, 11, 3).encode_all([t], [i])[0] for i, t in enumerate(texts)]


def test_share_of_skipped_candidates(vocabulary):
    encoder = pb.Encoder(vocabulary, 0.25, 5, 1)
    both = [len(encoder._segment(" t", v)) for v in range(4000)]
    assert np.mean([n == 2 for n in both]) == pytest.approx(0.25, abs=0.03)


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward_docs() + [(700 + i, t, None, None, None) for i, t in enumerate(TEXTS)], DOC).withColumn("Ids", F.lit("clash"))
    got = pb.encode(docs, pb.MODEL_FILE, 0.2, 9).cache()
    rows = got.collect()
    assert len(rows) == docs.count() and all(r.lossless and r.n_pieces == len(r.ids) for r in rows)
    assert "source" in got.columns and "text" not in got.columns
    back = {r.doc_id: r.text for r in pb.decode_ids(got, pb.MODEL_FILE).collect()}
    want = {r.doc_id: r.text or "" for r in docs.collect()}
    assert back == want
    assert pb.encode(docs.limit(0), pb.MODEL_FILE).count() == 0
    with pytest.raises(ValueError):
        pb.encode(docs, pb.MODEL_FILE, 1.0)


def test_query(spark, library):
    rows = pb.op6_piece_dropout(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs) and all(r.lossless for r in rows)
    assert all(library.decode(r.ids) == docs[r.doc_id] for r in rows[:50])


def test_every_place_draws_by_itself(vocabulary, spark):
    encoder = pb.Encoder(vocabulary, 0.1, 42, 0)
    whole = pb.Encoder(vocabulary, 0.0, 42, 0)._segment(" misunderstandings", 0)
    n = 20000
    ids = np.frombuffer(encoder.encode_all(["misunderstandings " * n], [7])[0], np.int32)
    cuts, at = {}, []
    for i in ids.tolist():
        if vocabulary.spelled[i][:1] == b" " and at:
            cuts[tuple(at)] = cuts.get(tuple(at), 0) + 1
            at = []
        at.append(i)
    met = []
    encoder._merge(" misunderstandings", lambda span: met.append(span))
    assert len(cuts) > 100
    # a place without a skipped candidate has the library's pieces, and some others come to the same
    assert cuts[whole] / n > 0.9 ** len(met) - 0.01
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("misunderstandings").alias("text"))
    assert pb.encode(docs, pb.MODEL_FILE, 0.1, 42).select("ids").distinct().count() > 20


@pytest.mark.parametrize("dropout", [0.1, 0.6])
def test_drawn_places_equal_one_by_one(vocabulary, spark, dropout, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(12).collect()] + TEXTS + ["", "word" * 40]
    encoder = pb.Encoder(vocabulary, dropout, 11, 0)
    drawn, plain = [], encoder._draw

    def noted(chunks, draws):
        drawn.extend(zip(chunks, draws.tolist(), strict=True))
        return plain(chunks, draws)

    monkeypatch.setattr(encoder, "_draw", noted)
    monkeypatch.setattr(pb, "PLACES", 500)
    monkeypatch.setattr(pb, "REMEMBERED", 3000)
    got = encoder.encode_all(texts, list(range(len(texts))))
    assert len({d for _, d in drawn}) == len(drawn)
    want = [i for c, d in drawn for i in encoder._segment(c, d)]
    assert np.frombuffer(b"".join(got), np.int32).tolist() == want
    assert [pb.decode(np.frombuffer(g, np.int32).tolist(), vocabulary) for g in got] == texts


MASK = (1 << 64) - 1


def plain_dropout(library, chunk, key, dropout):
    """Pieces of a chunk by the rule alone: of all neighbours that form a piece and are not skipped, the best merges, the first on a tie."""
    parts = [(c, i, i + 1) for i, c in enumerate(chunk.replace(" ", pb.SPACE))]
    while True:
        best = None
        for i, ((a, start, middle), (b, _, end)) in enumerate(zip(parts, parts[1:])):
            id = library.piece_to_id(a + b)
            if library.id_to_piece(id) != a + b:
                continue
            x = key ^ (start << 42 | middle << 21 | end)
            for _ in range(2):
                x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & MASK
            if x >> 32 >= int(dropout * 2**32) and (best is None or library.get_score(id) > best[0]):
                best = library.get_score(id), i
        if best is None:
            break
        i = best[1]
        parts[i:i + 2] = [(parts[i][0] + parts[i + 1][0], parts[i][1], parts[i + 1][2])]
    out = []
    for piece, _, _ in parts:
        id = library.piece_to_id(piece)
        out += [id] if library.id_to_piece(id) == piece else [library.piece_to_id(f"<0x{b:02X}>") for b in piece.encode()]
    return out


@pytest.mark.parametrize("dropout", [0.1, 0.5, 0.9])
def test_dropout_equals_the_rule(vocabulary, library, spark, dropout):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(8).collect()]
    texts += [t for t in TEXTS if pb.SPACE not in t and len(t) < 100 and t.isascii()]
    encoder, seed = pb.Encoder(vocabulary, dropout, 23, 0), 23
    for number, text in enumerate(texts):
        want, draw = [], 0
        for chunk in pb._CHUNK.findall(" " + text):
            draw += 1
            x = draw * 0x9E3779B97F4A7C15 + number & MASK
            x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & MASK
            key = seed * 0x9E3779B97F4A7C15 + x * 0xC2B2AE3D27D4EB4F + crc32(chunk.encode()) * 0x165667B19E3779F9 & MASK
            want += plain_dropout(library, chunk, key, dropout)
        assert encoder.encode(text, number) == want
