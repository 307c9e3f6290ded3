"""The pipeline's stages, each judged on its own input, and the registration."""

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from ledgerline.llm import minhash, quality
from ledgerline.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents").withColumnRenamed("n_chars", "kept")  # a name of an operator's own column
    columns = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF).cache()
        assert docs.columns == columns and docs.count() <= 3 * before.count(), name
        if name == "quality":
            model = quality.fit(before, table(spark, SF, "labels"))
            assert docs.count() == quality.score(before, model, out="p").where(f"p >= {quality.ACCEPT}").count()
        if name == "exact_dedup":
            assert docs.count() == len({" ".join(r.text.split()) for r in before.select("text").collect()})
        if name == "near_dedup":
            assert docs.count() == minhash.near_duplicates(before, width=5).select("component_id").distinct().count()
    coded = pipeline.STAGES[-1][1](spark, docs, SF)
    assert coded.count() == docs.count() and coded.where("not round_trip").count() == 0


def test_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
