"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import pytest

from pagequarry.llm import piece_bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "   ", "a", " a", "a  b   c    ", "▁" * 40 + "x", " " * 17 + "x" + " " * 33, "line\n\n\n next\r\n\t", "</s><s><unk>",
    "<0x41> <0x0A>", "é́漢\U0001f600 \U0001f600", "x\x00y", "².² m².", "ab" * 4_000, "1234567890 12 345", "� ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return piece_bpe.PieceModel(piece_bpe.read_spec(PATH))


def same(model, library, text):
    ids = np.frombuffer(model.framed(text), dtype="<u4")
    right = library.encode(text, add_bos=True, add_eos=True)
    assert ids.tolist() == right, text
    assert model.decode(ids) == library.decode(right)


def test_texts_of_any_kind_are_encoded_as_by_the_library(model, library):
    rng = random.Random(1)
    bits = [" ", "  ", "   ", "▁", "\n", "a", "the", "ing", "é", "漢", "\U0001f600", "x", "2024", " is", "</s>", "\t", "er", "́", "\x00", "----", "0", "."]
    for text in [t for t in ODD if t]:
        same(model, library, text)
    for _ in range(4_000):
        same(model, library, "".join(rng.choices(bits, k=rng.randint(0, 30))))


def test_every_character_is_encoded_as_by_the_library(model, library):
    characters = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(characters), 5):
        same(model, library, "a" + "".join(map(chr, characters[i : i + 5])) + " b")


def test_any_ids_are_decoded_as_by_the_library(model, library):
    rng = random.Random(2)
    for _ in range(5_000):
        ids = [rng.randrange(32_000) if rng.random() < 0.6 else rng.randrange(259) for _ in range(rng.randint(0, 12))]
        assert model.decode(np.array(ids, dtype="int64")) == library.decode(ids)


def test_pieces_that_allow_no_cuts_are_encoded_alike(model):
    whole = piece_bpe.PieceModel(piece_bpe.read_spec(PATH))
    whole.cut = whole.latin = piece_bpe.parts_pattern(["a▁b"])
    for text in ["two words, and more.\n\nnext  line", "x" * 300 + "  y", "². "]:
        assert whole.cut.findall(text) == [text] and whole.encode(text) == model.encode(text)
    assert piece_bpe.parts_pattern(["a.", "▁"]).findall(" a.b\n  c") == [" a.b", "\n", "  c"]
    assert piece_bpe.parts_pattern(["ab", "▁"]).findall(" ab.b\n") == [" ab", ".", "b", "\n"]


def test_models_it_would_read_otherwise_are_refused():
    spec = piece_bpe.read_spec(PATH)
    normalizer = spec.rindex(b"\x18\x01 \x00")
    with pytest.raises(ValueError):
        piece_bpe.PieceModel(spec[: normalizer + 3] + b"\x01" + spec[normalizer + 4 :])


def test_tables_round_trip(spark, library):
    rows = [(i, text, "n", "d") for i, text in enumerate(ODD)] + [(None, "no id", "n", None), (1, "", "n", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, decoded string")
    for row in piece_bpe.decode(piece_bpe.encode(docs, PATH), PATH).collect():
        assert row["ids"] == library.encode(row["text"] or "", add_bos=True, add_eos=True)
        assert row["decoded"] == library.decode(row["ids"])
    found = piece_bpe.round_trip(docs, PATH, outputs=(), keep_text=False)
    assert "text" not in found.columns
    for row in found.where("doc_id is not null").collect():
        ids = library.encode(ODD[row["doc_id"]] or "", add_bos=True, add_eos=True)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert piece_bpe.round_trip(docs.limit(0), PATH).count() == 0
