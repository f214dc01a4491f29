import random
import re

import xxhash
from pyspark.sql import functions as F

from pagemill.llm import components, simhash
from pagemill.llm.queries import QUERIES
from tests.llm.corners import TEXTS, corner_docs, no_docs

SF = "/root/testdata/sf0.001"


def fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_of(prints, bits=2):
    """Least place reachable over pairs at most ``bits`` apart."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(prints))]


def test_query(spark):
    rows = sorted((r.doc_id, fingerprint(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    roots = component_of([f for _, f in rows])
    expected = {d: (f"{f:016x}", rows[roots[i]][0]) for i, (d, f) in enumerate(rows)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash"](spark, SF).collect()}
    assert got == expected


def test_links_with_and_without_crowds(spark):
    rng = random.Random(8)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for base in list(prints)[:6]:  # chains and thick groups
        for _ in range(25):
            base ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            prints.add(base)
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    for bits in (1, 2):
        expected = component_of(prints, bits)
        groups = len(set(expected))
        for crowd in (1, 64):
            found = components.components(simhash.links(frame, bits=bits, crowd=crowd))
            linked = {r.node % (1 << 64): r.root for r in found.collect()}
            assert groups == len(prints) - len(linked) + len(set(linked.values()))
            for p, root in zip(prints, expected, strict=True):
                assert linked.get(p) == linked.get(prints[root])


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_corners(spark):
    docs = corner_docs(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS)
    empty = {r.component_id for r in rows if r.fingerprint == 0}
    assert empty == {3}
    assert {r.component_id for r in rows if r.doc_id == 2} == {min(r.component_id for r in rows if r.doc_id == 2)}
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    left = sorted((r.doc_id is None, r.doc_id) for r in kept.collect())
    groups = component_of([fingerprint(t) for _, t in TEXTS])
    assert len(left) == len(set(groups))
    assert kept.filter(F.col("doc_id") == 2).count() <= 1
    assert simhash.near_duplicates(no_docs(spark)).count() == 0 and simhash.drop_near_duplicates(no_docs(spark)).count() == 0
