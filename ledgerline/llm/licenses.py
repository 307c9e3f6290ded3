"""License scan as an exact set-similarity join, with DataFrame functions only.

Templates (short fixed notices) are the small side of the join: their size bounds
everything that is literal in the plan. The other side are text blocks: stretches of
2 M words that begin every M words, M being the longest template, so any M
consecutive words lie within one block. A pair joins when the block holds at
least ``threshold`` of the template's distinct words.

Filters, before a pair is verified on its full sets:

* prefix: words are ordered by their frequency in the corpus, rarest first. A
  template of t words that needs a of them must share one of its t - a + 1 rarest
  with the block; texts without any prefix word are left after one look;
* length: the block has at least a words of the template vocabulary;
* position: with the first shared prefix word at places i of the template and j of
  the block (both in corpus order), at most 1 + min(t - i - 1, b - j - 1) can be shared.

A block names a licence only when, besides the share, it holds the words that tell the
template from notices of other licences (``TELLING``): CC BY, the MPL or the LGPL share
all but a word, or all words, of the short notices of others.

Frequencies are counted over all texts. Nothing is shuffled but one row per template
word and map task.

Defined cases: a null or empty text has no words, no labels and score 0; repeated
rows give a row each; equal frequencies are ordered by the word; an empty table gives
an empty result (all frequencies are 0); other columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import table, text_or_empty

#: Base phrases and labels, fixed by the data contract.
PHRASES = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
#: Notices of public licences (fixed texts) and the method's own labels.
TEMPLATES = {
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-statement": "Released under the MIT License",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-notice": "This program is free software you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
}
#: What a block's words, with single spaces between and around them, must match to name a template's licence.
TELLING = {
    "mit-statement": r"(?s) mit ",
    "apache-2.0": r"(?s)^(?=.* apache )(?=.* v?2 )",
    "gpl-3.0": r"(?s)^(?=.* gnu general public licen[sc]e )(?=.* (?:gpl)?v?3 )",
    "gpl-notice": r"(?s) gnu general public licen[sc]e ",
    "mpl-2.0": r"(?s)^(?=.* mozilla public )(?=.* v?2 )",
    "cc-by-nc-4.0": r"(?s)^(?=.* by nc (?!sa |nd ))(?=.* v?4 )",
}
THRESHOLD = 0.8
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words. ``lower`` also maps letters beyond ASCII, which stay word characters."""
    return F.array_remove(F.split(F.lower(text), NOT_WORD, -1), "")


def template_words(text: str) -> list[str]:
    return [w for w in re.split(NOT_WORD, text.lower()) if w]


def corpus_order(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """The template words, rarest in the corpus first (one row per word comes back)."""
    counted = (docs.select(F.explode(words_of(F.col("_text"))).alias("w")).where(F.col("w").isin(vocabulary))
               .groupBy("w").agg(F.count("*").alias("n")).collect())
    n = {r["w"]: r["n"] for r in counted}
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def places(words: Column, phrase: list[str]) -> Column:
    """Word positions (from 0) where the phrase's words stand consecutively."""
    def here(i: Column) -> Column:
        same = F.lit(True)
        for k, word in enumerate(phrase):
            same = same & (F.get(words, i + k) == word)
        return same

    starts = F.filter(F.sequence(F.lit(0), F.size(words) - len(phrase)), here)
    return F.when(F.size(words) >= len(phrase), starts).otherwise(F.array().cast("array<int>"))


def containment(blocks: Column, ordered: list[str], threshold: float) -> Column:
    """The largest share of a template (words in corpus order) that a block holds, if at least ``threshold``."""
    t, need = len(ordered), math.ceil(threshold * len(ordered) - 1e-9)
    whole, prefix = strings(ordered), strings(ordered[:t - need + 1])

    def possible(b: Column) -> Column:
        first = F.get(F.array_intersect(b, prefix), F.lit(0))
        i, j = F.array_position(whole, first), F.array_position(b, first)
        return (F.size(b) >= need) & F.arrays_overlap(b, prefix) & (1 + F.least(t - i, F.size(b) - j) >= need)

    shared = F.transform(F.filter(blocks, possible), lambda b: F.size(F.array_intersect(b, whole)))
    return F.coalesce(F.array_max(F.filter(shared, lambda n: n >= need)) / F.lit(float(t)), F.lit(0.0))


def naming(words: Column, blocks: Column, step: int, ordered: list[str], threshold: float, telling: str | None) -> Column:
    """array<struct<start, share>>: first word and share of the blocks that hold enough of a template and its telling words."""
    t, need, whole = len(ordered), math.ceil(threshold * len(ordered) - 1e-9), strings(ordered)

    def block(b: Column, i: Column) -> Column:
        return F.struct((i * step).cast("int").alias("start"), (F.size(F.array_intersect(b, whole)) / F.lit(float(t))).alias("share"))

    enough = F.filter(F.transform(blocks, block), lambda x: x["share"] >= need / t - 1e-9)
    if telling is None:
        return enough
    spaced = lambda start: F.concat(F.lit(" "), F.array_join(F.slice(words, start + 1, F.lit(2 * step)), " "), F.lit(" "))
    return F.filter(enough, lambda x: spaced(x["start"]).rlike(telling))


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, ``base`` (label -> places), ``containment`` (label -> largest share
    of any block), ``blocks`` (label -> start and share of the blocks that name the licence)."""
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(f"`{text_col}`").alias("_text"))
    sets = {k: sorted(set(template_words(v))) for k, v in (TEMPLATES if templates is None else templates).items()}
    order = corpus_order(docs, sorted({w for s in sets.values() for w in s}))
    ordered = {k: [w for w in order if w in set(s)] for k, s in sets.items()}
    step = max((len(template_words(v)) for v in (TEMPLATES if templates is None else templates).values()), default=1)
    prefixes = sorted({w for s in ordered.values() for w in s[:len(s) - math.ceil(threshold * len(s) - 1e-9) + 1]})
    words, vocabulary = F.col("_words"), strings(order)
    rows = docs.select("doc_id", words_of(F.col("_text")).alias("_words"))
    rows = rows.select("doc_id", "_words", F.array_contains(words, "license").alias("_phrase"), F.arrays_overlap(words, strings(prefixes)).alias("_prefix"))
    # Words of the template vocabulary in each block, in corpus order.
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(words) - 1) / step).cast("int")),
                         lambda b: F.array_intersect(vocabulary, F.slice(words, b * step + 1, F.lit(2 * step))))
    rows = rows.withColumn("_blocks", F.when(F.col("_prefix"), blocks))
    none = F.array().cast("array<int>")
    base = {k: F.when(F.col("_phrase"), places(words, p)).otherwise(none) for k, p in PHRASES.items()}
    share = {k: F.when(F.col("_prefix"), containment(F.col("_blocks"), s, threshold)).otherwise(F.lit(0.0)) for k, s in ordered.items()}
    rows = rows.withColumn("_share", F.struct(*[c.alias(k) for k, c in share.items()]) if share else F.struct(F.lit(0.0).alias("none")))
    no_block = F.array().cast("array<struct<start:int,share:double>>")
    named = {k: F.when(F.col(f"_share.`{k}`") > 0, naming(words, F.col("_blocks"), step, s, threshold, TELLING.get(k) if templates is None else None))
             .otherwise(no_block) for k, s in ordered.items()}
    return rows.select("doc_id", F.size(words).cast("long").alias("n_words"),
                       F.struct(*[c.alias(k) for k, c in base.items()]).alias("base"),
                       F.col("_share").alias("containment"),
                       (F.struct(*[c.alias(k) for k, c in named.items()]) if named else F.struct(no_block.alias("none"))).alias("blocks"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    starts = F.concat(*[F.col(f"base.{k}") for k in PHRASES])
    some = lambda label, condition: F.when(condition, F.array(F.lit(label))).otherwise(F.array().cast("array<string>"))
    base = F.concat(*[some(k, F.size(f"base.{k}") > 0) for k in PHRASES])
    own = F.concat(*[some(k, F.size(f"blocks.`{k}`") > 0) for k in TEMPLATES])
    best = F.greatest(*[F.coalesce(F.array_max(F.col(f"blocks.`{k}`.share")), F.lit(0.0)) for k in TEMPLATES])
    places_of = lambda k: F.transform(f"blocks.`{k}`", lambda b: F.concat_ws(":", F.lit(k), b["start"].cast("string"), F.round(b["share"], 4).cast("string")))
    found = found.withColumns({"_starts": starts, "_base": base})
    return found.select("doc_id", "n_words", F.size("_starts").cast("long").alias("n_base"),
                        F.array_min("_starts").cast("long").alias("first_word"), F.array_max("_starts").cast("long").alias("last_word"),
                        F.array_join(F.array_sort("_base"), ",").alias("base_labels"),
                        F.array_join(F.array_sort(F.array_union("_base", own)), ",").alias("labels"),
                        F.when(F.size("_starts") > 0, F.lit(1.0)).otherwise(best).alias("score"),
                        F.array_join(F.concat(*[places_of(k) for k in TEMPLATES]), ",").alias("blocks"))
