import corpus_pipeline
from pyspark.sql import functions as F

from pagemill.llm import lines, simhash
from pagemill.storage import cut_lineage
from tests.llm.corners import corner_docs, no_docs

SF = "/root/testdata/sf0.001"


def test_stages_work_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["toxicity", "line dedup", "SimHash near-dedup", "benchmark decontamination", "BPE encoding and decoding"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, SF), "step")
        kept[name] = docs
        if name != "BPE encoding and decoding":
            assert docs.columns == columns
    toxic, clean = (labels.filter(F.col("toxic") == t).select("doc_id") for t in (1, 0))
    left = kept["toxicity"].select("doc_id")
    assert left.join(clean, "doc_id").count() >= 0.97 * clean.count()
    assert left.join(toxic, "doc_id").count() < toxic.count()  # few labels at this scale; the classifier's own test is stricter
    again = lines.line_classes(kept["line dedup"])
    assert again.filter(lines.removable()).count() == 0
    groups = simhash.near_duplicates(kept["SimHash near-dedup"])
    assert groups.select("component_id").distinct().count() == groups.count()
    assert docs.count() == kept["benchmark decontamination"].count()
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, docs.collect()))


def test_corners(spark):
    for _, stage in corpus_pipeline.STAGES:
        docs = corner_docs(spark)
        out = stage(spark, docs, SF)
        assert out.count() <= docs.count()
        assert stage(spark, no_docs(spark), SF).count() == 0
