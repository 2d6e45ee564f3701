from pyspark.sql import functions as F

from tests.llm.conftest import SF


def test_pipeline_stages_against_plain_versions(spark):
    import corpus_pipeline as C
    from tessera.llm import ngram_join, quality_gam
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = C.quality(spark, docs, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert good.join(labels.where("quality = 1"), "doc_id").count() == docs.join(labels.where("quality = 1"), "doc_id").count()
    kept = C.near_copies(spark, good, SF)
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    from tests.llm.test_mixing_join import _brute
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in _brute(rows, 5, 80, 100)})
    clean = C.secrets(spark, kept, SF)
    assert clean.count() == kept.count() and clean.columns == docs.columns
    mixed = C.source_mix(spark, clean, SF)
    assert mixed.columns == docs.columns
    words = lambda df: df.agg(F.sum(F.size(F.split(F.trim("text"), r"\s+")))).first()[0]
    assert abs(words(mixed) / words(clean) - 1) < 0.2
    ids = C.piece_ids(spark, mixed, SF)
    assert ids.count() == mixed.count()
    assert quality_gam and ngram_join


def test_pipeline_of_odd_rows(spark, odd, none, tmp_path):
    import corpus_pipeline as C
    for docs in (odd, none):
        for _, stage in C.STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()
