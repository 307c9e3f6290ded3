"""Labels of notices that share most words with another licence's, and the blocks found."""

import pytest

from ledgerline.llm import licenses

FILL = "filler " * 100
CASES = [
    ("Licensed under CC BY 4.0", ""), ("Licensed under CC BY-NC-SA 4.0", ""), ("licensed under the Mozilla Public License, version 2.0", ""),
    ("Released under the Apache License", ""), ("This work is licensed under the GNU Lesser General Public License, version 3", ""),
    ("This work is licensed under the GNU Affero General Public License, version 3", ""),
    ("This work is licensed under the GNU General Public License, version 2", ""), ("Licensed under CC BY-NC 4.0", "cc-by-nc-4.0"),
    ("Released under the MIT License", "mit-statement"), ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3.0"), (licenses.TEMPLATES["gpl-notice"], "gpl-notice"),
    (licenses.TEMPLATES["gpl-notice"].replace("GNU", "GNU Lesser"), ""), (licenses.TEMPLATES["mpl-2.0"], "mpl-2.0"),
    (licenses.TEMPLATES["bsd"], "bsd"), (licenses.TEMPLATES["mit-notice"], "mit-notice"), ("", ""),
]


def test_telling_words_and_block_starts(spark, tmp_path):
    texts = [t for t, _ in CASES] + [FILL + t for t, _ in CASES]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    step = max(len(licenses.template_words(v)) for v in licenses.TEMPLATES.values())
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r for r in licenses.op3_license_scan(spark, str(tmp_path)).collect()}
    for r in licenses.license_scan(docs).collect():
        i = r["doc_id"]
        label = CASES[i % len(CASES)][1]
        found = {k: v for k, v in r["blocks"].asDict().items() if v}
        assert sorted(found) == [label] * bool(label), texts[i]
        words = licenses.template_words(texts[i])
        for k, blocks in found.items():
            of = set(licenses.template_words(licenses.TEMPLATES[k]))
            want = [(s, len(of & set(words[s:s + 2 * step])) / len(of)) for s in range(0, len(words), step)]
            assert [tuple(b) for b in blocks] == [(s, pytest.approx(x)) for s, x in want if x >= 0.8]
        own = set(out[i]["labels"].split(",")) - {"", *licenses.PHRASES}
        assert own == {label} - {""} and out[i]["blocks"] == ",".join(f"{k}:{b['start']}:{b['share']:.4g}" if b["share"] < 1 else f"{k}:{b['start']}:1.0" for k, v in found.items() for b in v)
        assert out[i]["score"] == (1.0 if out[i]["n_base"] else max((b["share"] for v in found.values() for b in v), default=0.0))
