import random

import pytest

from pagemill.llm import edits, lines
from pagemill.llm.queries import QUERIES
from tests.llm.corners import TEXTS, corner_docs, no_docs

SF = "/root/testdata/sf0.001"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, text, most):
    out = list(text)
    for _ in range(rng.randrange(most + 1)):
        at, how = rng.randrange(len(out) + 1), rng.random()
        if how < 0.4 or not out:
            out.insert(at, rng.choice("abé"))
        elif how < 0.7:
            del out[min(at, len(out) - 1)]
        else:
            out[min(at, len(out) - 1)] = rng.choice("abé")
    return "".join(out)


@pytest.mark.parametrize("most", [1, 2, 3])
def test_keys_and_distances(most):
    rng = random.Random(most)
    first = ["".join(rng.choice("abé") for _ in range(rng.randrange(28))) for _ in range(700)]
    second = [changed(rng, a, most + 2) for a in first]
    expected = [min(plain_distance(a, b), most + 1) for a, b in zip(first, second, strict=True)]
    assert edits.distances(first, second, most).tolist() == expected
    for a, b, d in zip(first, second, expected, strict=True):
        if d <= most:
            (ia, pa), (ib, pb) = ([{k for k, r, _, _ in edits.keys(s, most) if r & role} for role in (1, 2)] for s in (a, b))
            assert ia & pb or ib & pa


def expected_classes(rows, least=lines.LEAST_CHARS, most=lines.MOST):
    """First place of the class of every line, by comparing all lines; those under ``least`` letters have to be equal."""
    places = {}
    for key, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for i, raw in enumerate((text or "").split("\n") if text is not None else []):
            line = raw.strip(lines.BLANK)
            if line:
                places.setdefault(line, []).append((key is None, key or 0, i))
    distinct = sorted(places, key=len)
    root = {s: s for s in distinct}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for i, a in enumerate(distinct):
        near = [b for b in distinct[i + 1 :] if len(b) - len(a) <= most] if len(a) >= least else []
        for b, d in zip(near, edits.distances([a] * len(near), near, most) if near else [], strict=True):
            if d <= most:
                root[find(a)] = find(b)
    first = {}
    for line, at in places.items():
        first[find(line)] = min([*at, *([first[find(line)]] if find(line) in first else [])])
    return {(p[1], p[2]): (first[find(line)][1], first[find(line)][2]) for line, at in places.items() for p in at}


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {(r.doc_id, r.line_no): (r.class_doc_id, r.class_line_no) for r in QUERIES["op3_lines"](spark, SF).collect()}
    assert got == expected_classes(rows)


@pytest.mark.parametrize("crowd, group", [(1, 5), (1, 1000), (64, 1000)])
def test_crowded_keys_lose_no_link(spark, crowd, group):
    rng = random.Random(3)
    base = "the common part of many lines is long and "
    texts = ["\n".join(changed(rng, base + rng.choice(["one", "two", "three thousand and four", "none"]) * 2, 3) for _ in range(8)) for _ in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = expected_classes(list(enumerate(texts)))
    links = {(r.a.hex(), r.b.hex()) for r in lines.close_lines(docs, crowd=crowd, group=group).collect()}
    assert links
    whole = lines.line_classes(docs).collect()
    got = {(r.key, r.line_no): (r.first.key, r.first.line_no) if r.first else (r.key, r.line_no) for r in whole}
    assert got == expected
    import hashlib

    text_of = {hashlib.md5(s.strip(lines.BLANK).encode()).hexdigest(): s.strip(lines.BLANK) for t in texts for s in t.split("\n")}
    assert all(plain_distance(text_of[a], text_of[b]) <= 2 for a, b in links)
    root = {}

    def find(s):
        while root.setdefault(s, s) != s:
            s = root[s]
        return s

    for a, b in links:
        root[find(a)] = find(b)
    classes = {find(hashlib.md5(s.encode()).hexdigest()) for s in text_of.values()}
    assert len(classes) == len(set(expected.values()))


def test_numbered_lines_meet_in_few_pairs(spark, monkeypatch):
    rng = random.Random(5)
    texts = [f"Order {n:07d} was shipped to the customer at the address given below, thank you for it" for n in rng.sample(range(10**7), 2500)]
    texts += [f"Ticket {n} was closed by the team after all the questions in it had been answered" for n in range(600)]
    texts += [f"Room {a}{b} of the large building is free on all days of the next week" for a in "abcdefghijk" for b in "lmnopqrst12"]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    met, verified = [], lines._verified
    monkeypatch.setattr(lines, "_verified", lambda pairs, most: met.append(pairs.count()) or verified(pairs, most))
    links = lines.close_lines(docs, crowd=8, group=64)
    assert met[0] < 20 * len(texts)
    import hashlib

    number = {hashlib.md5(t.encode()).digest(): i for i, t in enumerate(texts)}
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in links.collect():
        i, j = sorted((find(number[bytes(r.a)]), find(number[bytes(r.b)])))
        root[j] = i
    assert {(i, 0): (find(i), 0) for i in range(len(texts))} == expected_classes(list(enumerate(texts)))


def test_short_lines_have_to_be_equal(spark):
    texts = ["Yes.\nA line of some more letters.\n\n \nYes", " Yes. \nA line of some more letter.\nab", "ab\nac\n\nYes.\nfifteen letters", None, "fifteen letter"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id: r.text for r in lines.drop_repeated_lines(docs).collect()}
    assert kept == {0: texts[0], 1: "ab", 2: "ac\n\nfifteen letters", 3: None, 4: "fifteen letter"}


def test_corners(spark):
    docs = corner_docs(spark)
    kept = lines.drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    texts = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    expected = [(d, "" if d == 2 else t) for d, t in TEXTS]
    assert texts == sorted(expected, key=repr)
    assert lines.drop_repeated_lines(no_docs(spark)).count() == 0
