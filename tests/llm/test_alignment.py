"""Alignment of two tokenizers against a plain loop over all pairs of tokens."""

import copy
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pagequarry.llm import alignment, bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")
PATH_A, PATH_B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    None, "", " ", "a", "Historic temples, and\n\n  other   places.", "<|endoftext|> and </s> are text", "▁ is not a space", "été 漢字 \U0001f600!",
    "same words, same words, same words", "same words, same words, same words", "x" * 3_000, "12345 6789 0.5", "\r\n\t end ",
]


def spans(sizes):
    ends = np.cumsum(sizes).tolist()
    return list(zip([0, *ends], ends, strict=False))


def brute(texts):
    a, b = tokenizers.Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    a.encode_special_tokens = True
    stand_ins = {c: bytes([n]) for c, n in bpe.byte_alphabet().items()}

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    found, holders = [], Counter()
    for text in texts:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        raw_a = [b"".join(stand_ins[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes_b(i) for i in ids_b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            found.append(([], [], [], 0, ""))
            continue
        spans_a, spans_b = spans(list(map(len, raw_a))), spans(list(map(len, raw_b)))
        links = [(i, j) for i, (s, e) in zip(ids_a, spans_a, strict=True) for j, (t, f) in zip(ids_b, spans_b, strict=True) if s < f and t < e]
        cuts = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups, before = [], 0
        for cut in cuts:
            part = [[str(i) for i, (_, e) in zip(ids, all_spans, strict=True) if before < e <= cut] for ids, all_spans in ((ids_a, spans_a), (ids_b, spans_b))]
            groups.append("|".join(",".join(p) for p in part))
            before = cut
        holders.update(set(links))
        found.append((ids_a, ids_b, links, len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (i, _), n in holders.items():
        best[i] = max(best[i], n)
    return [
        (len(x), len(y), groups, len(links), sum(holders[p] == best[p[0]] for p in links), sum(holders[p] for p in links), digest)
        for x, y, links, groups, digest in found
    ]


def test_rows_are_those_of_brute_force(spark, monkeypatch):
    # a slice holds a few texts only, so lists meet over the whole table
    monkeypatch.setattr(alignment, "SLICE_BYTES", 40)
    rows = [(i, text, "old", 7) for i, text in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string, n_a long").repartition(3)
    found = alignment.cross_align(docs, PATH_A, PATH_B)
    assert "text" not in found.columns
    expected = brute(TEXTS)
    for row in found.collect():
        assert tuple(row[c] for c in alignment.RESULTS) == expected[row["doc_id"]], TEXTS[row["doc_id"]]
        assert row["note"] == "old"


def test_empty_tables_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "one two"), (1, "one two"), (1, "one two"), (2, None)], "doc_id long, text string")
    found = alignment.cross_align(docs, PATH_A, PATH_B, keep_text=True).collect()
    assert len(found) == 4
    assert {r["count_sum"] for r in found if r["text"]} == {3 * r["n_links"] for r in found if r["text"]}
    assert alignment.cross_align(docs.limit(0), PATH_A, PATH_B).count() == 0
    nothing = alignment.cross_align(docs.where("doc_id = 2"), PATH_A, PATH_B).first()
    assert (nothing["n_links"], nothing["n_best"], nothing["count_sum"], nothing["groups_sha256"]) == (0, 0, 0, "")


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    numbers = np.concatenate([rng.integers(0, 1 << int(bits), 50) for bits in rng.integers(1, 40, 30)])
    packed, sizes = alignment.pack(numbers)
    assert len(packed) == sizes.sum() and (alignment.unpack(packed) == numbers).all()
    assert alignment.pack(numbers[:0])[0] == b"" and len(alignment.unpack(b"")) == 0


def test_words_are_encoded_alike_with_and_without_the_library():
    coder = alignment.tokenizer(alignment.read_spec(PATH_A))
    other = copy.copy(coder)
    other.ids = coder.ids[::-1]  # not in the order of the merges, so the library cannot be asked
    fast, plain = alignment._piece_encoder(coder), alignment._piece_encoder(other)
    for word in (" historic", "é漢\U0001f600", " " * 70, "a" * 3_000, "'s", "\n\n", "<|endoftext|>"):
        assert fast(word) == coder.encode_piece(word.encode())
        assert plain(word) == other.encode_piece(word.encode()) != fast(word)
