"""Operator 11 against the sentencepiece library, id by id."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from ledgerline.llm import piece_bpe

PATH = public_tokenizers.path(piece_bpe.MODEL)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return piece_bpe.PieceModel(PATH)


def random_text(rng: random.Random, pieces: list[str]) -> str:
    kind = rng.randrange(5)
    if kind == 0:
        return "".join(rng.choices(pieces, k=rng.randint(0, 12))).replace("▁", " ")
    if kind == 1:
        return "".join(rng.choices("ab c-=_▁  \n\t0", k=rng.randint(0, 300)))
    if kind == 2:
        ranges = [(32, 126), (0, 0x2FF), (0x3000, 0xD7FF), (0x10000, 0x1FFFF)]
        return "".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(rng.randint(0, 60)))
    if kind == 3:  # one word over many blocks
        return "".join(rng.choices("etaoinshrdlucmfw", k=rng.randint(0, 2000)))
    return rng.choice(["a", "-", "=", "ab", "the", " ", "\n", "in", "."]) * rng.randint(1, 700) + rng.choice(["", "x", " a"])


def test_random_texts_equal_the_library(model, library):
    rng = random.Random(5)
    pieces = [library.id_to_piece(i) for i in range(3, library.vocab_size())]
    texts = [random_text(rng, pieces) for _ in range(1200)]
    coded = model.encoder()
    ids = [np.frombuffer(x, "<i4") for start in range(0, len(texts), 100) for x in coded(texts[start:start + 100])]
    for text, got in zip(texts, ids):
        assert got.tolist() == library.encode(text), text[:100]
    assert model.decode(ids) == [library.decode(x.tolist()).encode() for x in ids]


def test_decoding_ids_that_no_text_gives(model, library):
    rng = random.Random(6)
    ids = [np.array([rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(300) for _ in range(rng.randint(0, 20))], "int32")
           for _ in range(1500)]
    assert model.decode(ids) == [library.decode(x.tolist()).encode() for x in ids]


@pytest.mark.parametrize("text", [" " * 200_003 + "x", "a" * 300_001, "=-" * 200_000, "".join(random.Random(1).choices("etaoinshrdlu", k=300_000)),
                                  " ".join(["verylong", "text"] * 400_000)], ids=["spaces", "one letter", "two signs", "letters", "words"])
def test_very_long_texts(model, library, text):
    assert np.frombuffer(model.encoder()([text])[0], "<i4").tolist() == library.encode(text)


def test_forgetting_words_changes_nothing(model, library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "REMEMBERED_BYTES", 200)
    monkeypatch.setattr(piece_bpe, "HANDED", 50)
    coded, rng = model.encoder(), random.Random(2)
    for _ in range(60):
        texts = [" ".join(rng.choices(["weather", "of", "the", "x" * 90, "naïve", "日本"], k=9)) for _ in range(4)]
        assert [np.frombuffer(x, "<i4").tolist() for x in coded(texts)] == [library.encode(t) for t in texts]


def test_a_piece_that_makes_a_better_pair_merges_alone():
    """ab has a worse rank than aba, so in ababa the first ab must become aba before the next ab."""
    model = piece_bpe.PieceModel.__new__(piece_bpe.PieceModel)
    names = ["a", "b", "aba", "ab"]
    ids = {p: i for i, p in enumerate(names)}
    model.known = model.pieces = 4
    model.symbol_of = np.arange(0x110000, dtype="int32") + 4
    model.symbol_of[[ord("a"), ord("b")]] = [0, 1]
    model.rank_of = np.array([9, 8, 0, 1], "int32")
    model.plain = np.array([True, True, True, False])
    model.block = 12
    model.keys, model.made = model.hashed({(ids[a], ids[b]): ids[a + b] for a, b in (("a", "b"), ("ab", "a"))})
    for word, want in (("ababa", ["aba", "b", "a"]), ("abab", ["aba", "b"]), ("ab" * 40, None)):
        parts = list(word)
        while True:  # one pair at a time
            options = [(model.rank_of[ids[x + y]], k) for k, (x, y) in enumerate(zip(parts, parts[1:])) if (x, y) in {("a", "b"), ("ab", "a")}]
            if not options:
                break
            k = min(options)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        assert want is None or parts == want
        assert [names[s] for s in model.merged([word])[0]] == parts


def test_query_rows(spark, model, library):
    texts = [None, "", " ", "a", "▁a b", "<s> </s>", "naïve 日本 𝒳\x00", "a", "x" * 5000]
    rows = [(i % 7, t, "en", 1, "q") for i, t in enumerate(texts)]  # repeated ids, and names the operator uses
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids int, `a.b` string").repartition(3)
    want = sorted((i, len(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t, *_ in rows)
    coded = piece_bpe.encode(df, model, decoded=True)
    assert sorted((r["doc_id"], len(r["ids"]), r["decoded"]) for r in coded.collect()) == want
    again = piece_bpe.decode(coded.select("doc_id", "ids"), model)
    assert sorted((r["doc_id"], len(r["ids"]), r["decoded"]) for r in again.collect()) == want
    assert [r["decoded"] for r in piece_bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), model).collect()] == [None]
    kept = piece_bpe.encode(df, model, keep=["a.b", "doc_id"])
    assert kept.columns == ["a.b", "doc_id", "ids"] and kept.count() == len(rows)
    assert piece_bpe.encode(df.limit(0), model, decoded=True).count() == 0


def test_registered_query(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = piece_bpe.op11_piece_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
