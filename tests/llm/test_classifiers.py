import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import quality, toxicity
from pagemill.llm.labelled import Sample, fit_sigmoid
from pagemill.llm.queries import QUERIES
from tests.llm.corners import TEXTS, corner_docs, no_docs

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name, label, wrong", [("op6_quality", "quality", 0.06), ("op8_toxicity", "toxic", 0.04)])
def test_held_out_rows(spark, name, label, wrong):
    scored = QUERIES[name](spark, SF)
    assert dict(scored.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = scored.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    known = [r for r in rows if r.held_out and r[label] is not None]
    assert sum(r.predicted != r[label] for r in known) < wrong * len(known)
    assert sum(r.predicted == r[label] for r in known if r[label] == 1) > 0.8 * sum(r[label] == 1 for r in known)


def test_gaps_and_inserted_letters():
    clean = [f"the house number {i} is on the long road to the north" for i in range(60)]
    toxic = [f"the {w} number {i} is on the long road" for i in range(60) for w in (["dumbhead", "stinkfool"][i % 2],)]
    halves = np.array([i // 2 % 2 == 0 for i in range(120)])
    model = toxicity.fit(Sample(clean + toxic, np.r_[np.zeros(60, int), np.ones(60, int)], halves))
    odd = ["you dumbhead", "d u m b h e a d", "dum.bhe-ad", "dumxbhead", "STINKFOOL!", "dümbhead", "stinkfoool"]
    good = ["the house on the road", "north", "", None, "a long long road", "12 34", "\n"]
    clear, marked = model.probability(model.raw(good, {})), model.probability(model.raw(odd, {}))
    assert clear.max() < 0.5 and marked.min() > clear.max()
    assert model.word_scores(["dumbhead", "dumxbhead", "stinkfoool"]).min() > model.word_scores(["house", "north", "number"]).max()


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_corners(spark, module, label):
    docs = corner_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1), (6, 1, 0), (7, 0, 0), (None, 1, 1), (8, None, None), (9, 7, 7)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.filter(F.col(label) == 1)):
        model = module.learn(docs, known)
        rows = module.score(docs, model).collect()
        assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if not r.text}) == 1
        assert module.score(no_docs(spark), model).count() == 0
    assert module.score(docs, module.learn(no_docs(spark), labels)).count() == len(TEXTS)


def test_sigmoid_with_one_class():
    assert fit_sigmoid(np.array([1.0, 2.0]), np.array([1, 1]))[0] == 0
    slope, shift = fit_sigmoid(np.array([0.0, 1.0, 2.0, 3.0]), np.array([0, 0, 1, 1]))
    assert slope > 0 and slope * 1.5 + shift == pytest.approx(0, abs=0.2)
