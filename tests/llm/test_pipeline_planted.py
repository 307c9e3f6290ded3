"""The deduplicating and encoding stages on planted documents, against plain Python."""

import re

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline as pipeline
from ledgerline.llm import byte_bpe

WIDTH = 5


def shingles(text: str) -> set:
    words = text.lower().split()
    return {tuple(words[i:i + WIDTH]) for i in range(len(words) - WIDTH + 1)} or ({tuple(words)} if words else set())


def test_planted_copies(spark):
    texts = {}
    for k in range(10):
        base = [f"w{k}_{i}" for i in range(94)]  # 90 shingles
        texts[10 * k] = " ".join(base)
        texts[10 * k + 1] = "  ".join(base)  # an exact copy but for white space
        texts[10 * k + 2] = " ".join(base[:76])  # 72 of 90: similarity 0.8
        texts[10 * k + 3] = " ".join(base[:75])  # 71 of 90: under 0.8 to the base, linked over the one before
        texts[10 * k + 4] = " ".join([*base[:75], *[f"x{k}_{i}" for i in range(5)]])
        texts[10 * k + 5] = " ".join(f"clean{k}_{i}" for i in range(40))
        texts[10 * k + 6] = " ".join(f"u{k}_{i}" for i in range(94))  # a pair just under 0.8 and nothing between
        texts[10 * k + 7] = " ".join(f"u{k}_{i}" for i in range(75))
    texts |= {200: "", 201: "one two", 202: "One two", 203: "one  two"}
    docs = spark.createDataFrame([(i, t, "ab"[i % 2]) for i, t in texts.items()], "doc_id long, text string, source string").repartition(3)
    stages = dict(pipeline.STAGES)

    first: dict[str, int] = {}
    for i in sorted(texts):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    exact = stages["exact_dedup"](spark, docs, "").cache()
    assert sorted(r["doc_id"] for r in exact.collect()) == sorted(first.values())

    sets = {i: shingles(texts[i]) for i in first.values()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    assert root(3) == 0 and root(7) == 7
    near = stages["near_dedup"](spark, exact, "").cache()
    assert sorted(r["doc_id"] for r in near.collect()) == sorted({root(i) for i in sets})

    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS)), special_tokens={})
    coded = stages["encode"](spark, near, "").collect()
    assert sorted(r["doc_id"] for r in coded) == sorted({root(i) for i in sets})
    assert all(np.frombuffer(bytes(r["ids"]), "<u4").tolist() == own.encode_ordinary(texts[r["doc_id"]]) and r["round_trip"] for r in coded)
