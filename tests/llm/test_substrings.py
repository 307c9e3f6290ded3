"""Runs of one character at the last level, where whole windows are the keys."""

import collections

import numpy as np

from ledgerline.llm import substrings

LEAST = 40


def test_runs_of_one_character_need_no_expansion(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a text was expanded at the last level")

    texts = ["a" * n for n in (39, 40, 41, 500, 3000)] + ["x" + "a" * 60 + "y", "b" * 40, "c" * 41, "d" * 40 + "e" * 40, "ab" * 60, "f" * 39 + "g" * 39, "é" * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    raw = [t.encode() for t in texts]
    seen = collections.Counter(t[s:s + LEAST] for t in raw for s in range(len(t) - LEAST + 1))
    for strings, heavy in (((None,), 1 << 22), ((16, None), 1)):
        if len(strings) == 1:
            monkeypatch.setattr(substrings, "expanded", refuse)
        else:
            monkeypatch.undo()
        got = {r["doc_id"]: r for r in substrings.remove_repeats(docs, LEAST, strings, 1 << 12, heavy).collect()}
        for i, t in enumerate(raw):
            gone = np.zeros(len(t), bool)
            for s in range(len(t) - LEAST + 1):
                if seen[t[s:s + LEAST]] > 1:
                    gone[s:s + LEAST] = True
            assert bytes(got[i]["kept"]) == bytes(c for c, g in zip(t, gone) if not g), (strings, texts[i][:50])
