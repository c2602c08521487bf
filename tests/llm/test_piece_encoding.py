"""Ids and decoded texts against the library that the model comes from."""

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from scenetrail.llm import piece_encoding

PATH = public_tokenizers.path("piece_bpe_32k.model")
RNG = np.random.default_rng(11)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return piece_encoding.Encoder(piece_encoding.Vocabulary(PATH))


@pytest.fixture(scope="module")
def decode():
    return piece_encoding.decoder(piece_encoding.Vocabulary(PATH))


def ids_of(encoder, text):
    return np.frombuffer(encoder(text), "<i4").tolist()


def strange(n, letters):
    return "".join(RNG.choice(list(letters), n))


TEXTS = [
    "", " ", "   ", "a", " a", "a ", "Hello  world \n\t x", "▁", "▁a ▁ b▁", "\x00\x01", "é́ﬁ", "日本語と漢字 ありがとう", "😀😃 👍🏽", "<s></s><unk><0x41>", "�",
    "a" * 3000, "ab" * 2000, " " * 777, "\n" * 50, "x" * 65_540, "tion" * 500 + " er" * 500, "ööß " * 100,
    *(strange(int(RNG.integers(1, 300)), "aeinrst ohlu") for _ in range(300)),
    *(strange(int(RNG.integers(1, 60)), "the ing▁  \n.,éüß0123456789") for _ in range(300)),
    *(strange(int(RNG.integers(1, 30)), [chr(c) for c in range(32, 0x2FF)] + ["中", "文", "😀"]) for _ in range(300)),
]


def test_ids_and_text(library, encoder, decode):
    for text in TEXTS:
        ids = ids_of(encoder, text)
        assert ids == library.encode(text), text[:50]
        assert decode(ids) == library.decode(ids), text[:50]


def test_pieces_as_texts(library, encoder):
    """Every piece of the vocabulary, also those that merges do not lead to."""
    pieces = [p.replace("▁", " ") for p in encoder.piece if not p.startswith('<')]
    assert [ids_of(encoder, p) for p in pieces] == library.encode(pieces)


def test_foreign_ids(library, decode):
    for _ in range(300):
        ids = [int(i) for i in RNG.choice([*range(300), 29871, 29901, 13, 450], int(RNG.integers(0, 12)))]
        assert decode(ids) == library.decode(ids), ids


def test_round_trip(spark, library):
    rows = [(i, t, "clash", 1) for i, t in enumerate([*TEXTS, None, "same", "same", "long text " * 30_000])] + [(None, "no id", "clash", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, _row int").repartition(5)
    ids = df.select("doc_id", piece_encoding.piece_ids(df.text, PATH).alias("ids"))
    apart = {r.doc_id: r.text for r in ids.select("doc_id", piece_encoding.piece_text(ids.ids, PATH).alias("text")).collect()}
    found = piece_encoding.round_trip(df, PATH)
    assert found.columns == ["doc_id", "text", "_row", "ids", "decoded"]
    got = {r.doc_id: (list(r.ids), r.decoded) for r in found.select("doc_id", "ids", "decoded").collect()}
    assert got == {i: (library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t, _, _ in rows}
    assert apart == {i: text for i, (_, text) in got.items()}
    assert piece_encoding.round_trip(df.limit(0), PATH).count() == 0


def test_query(spark, library):
    import hashlib

    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = piece_encoding.op12_piece_encoding(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pairs_by_merging_again(encoder):
    """The two lists of merges give what merging the joined text gives, for neighbours that do and do not suit."""
    known = np.array(list(encoder.border))
    near = np.array([encoder.single[c] for c in "aeinrst▁"] + [i for i in encoder.border if encoder.size[i] == 2][:400])
    sides = np.where(RNG.random((60_000, 2)) < 0.5, RNG.choice(near, (60_000, 2)), RNG.choice(known, (60_000, 2)))
    for left, right in sides.tolist():
        pieces = [encoder.piece[left], encoder.piece[right]]
        assert encoder.suits(left, right) == (piece_encoding.merged("".join(pieces), encoder.score)[0] == pieces), pieces
