import re
import zlib
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from pagemill.llm import audit
from pagemill.llm.queries import ORACLES, QUERIES
from tests.llm.corners import corner_docs, counted, no_docs
from tools import check

SF = "/root/testdata/sf0.001"
LONG = "word %d of a long text, Title "


def plain(rows, labels):
    """Each order applied to each document, one after the other."""
    texts = [(i, part or "", text or "") for i, part, text in rows]
    first = {}
    for i, _, t in texts:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    failed = []
    for i, part, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        failed.append((part, "".join(f for f in "ABCDE" if fails[f]), i in good, i in toxic))
    out, shapley = [], Counter()
    for part in {p for p, *_ in failed}:
        mine = [x for x in failed if x[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                goes = [x for x in left if f in x[1]]
                before = [x for x in mine if f in x[1] and set(x[1]) & set(order[: step - 1])]
                left = [x for x in left if f not in x[1]]
                shapley[part, f] += len(goes)
                out.append([part, order, step, len(left), len(goes), len(before), sum(x[1] == f for x in mine), sum(x[2] for x in goes), sum(x[3] for x in goes)])
    return [(*row, shapley[row[0], row[1][row[2] - 1]]) for row in out]


def test_query(spark):
    connection = check.oracle(SF)
    got = QUERIES["op11_filters"](spark, SF)
    columns = ", ".join(got.columns)
    expected = connection.execute(f"SELECT {columns} FROM ({ORACLES['op11_filters']})").fetchall()
    assert counted(tuple(r) for r in got.collect()) == counted(expected)


def test_against_each_order_applied(spark):
    rows = [(i, "LANG"[i % 4], (LONG % i) * (i % 60)) for i in range(90)]
    rows += [(200 + i, "A", "a hot text that many rows share & more") for i in range(60)] + [(i, None, None) for i in (500, 501, 502)]
    rows += [(None, "A", "a hot text that many rows share & more"), (200, "A", "a hot text that many rows share & more"), (None, "N", None), (7, "A", "é" * 300 + "ABC " * 3)]
    labels = [(i, zlib.crc32(b"%d" % i) % 3 or None, i % 2) for i in range(0, 90, 2)] + [(200, 1, 1), (200, 0, 1), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5).withColumns({c: F.lit("own") for c in ("key", "part", "mask", "digest", "n")})
    got = audit.filter_audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert counted(tuple(r) for r in got.collect()) == counted(plain(rows, labels))


def test_other_filters(spark):
    docs = spark.createDataFrame([(1, "x", "a b"), (2, "x", "a b"), (3, "x", "c")], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = audit.filter_audit(docs, labels, {"S": lambda t: t.words < 2}).collect()
    assert {(r.filter_order, r.step, r.kept, r.removed) for r in rows} == {("SE", 1, 2, 1), ("SE", 2, 1, 1), ("ES", 1, 2, 1), ("ES", 2, 1, 1)}


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_facts_in_pieces(piece):
    text = "One two\ttwo  three\x0bÉÉ |\n" * 9 + "x" * 40
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    assert audit.text_facts(text.encode(), piece) == (len(words), len(set(words)), 9, len(text), True)
    assert audit.text_facts(b"", piece) == (0, 0, 0, 0, False)


def test_corners(spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    docs = corner_docs(spark)
    got = counted(tuple(r) for r in audit.filter_audit(docs, labels).collect())
    assert got == counted(plain([(r.doc_id, r.lang, r.text) for r in docs.collect()], [(1, 1, 0)]))
    assert audit.filter_audit(no_docs(spark), labels).count() == 0
