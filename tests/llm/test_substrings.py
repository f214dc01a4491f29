import hashlib
import random

import numpy as np
import pytest

from pagemill.llm import substrings as S
from pagemill.llm.queries import QUERIES
from tests.llm.corners import TEXTS, corner_docs, counted, no_docs

SF = "/root/testdata/sf0.001"


def expected(rows, length):
    raw = [(key, (text or "").encode()) for key, text in rows]
    seen = {}
    for _, data in raw:
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            seen[window] = seen.get(window, 0) + 1
    out = []
    for key, data in raw:
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((key, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def results(frame):
    return [(r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in frame.collect()]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op10_substrings"](spark, SF).collect()]
    assert counted(got) == counted(expected(rows, S.LENGTH))


@pytest.mark.parametrize("crowd", [256, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_like_counting_all_windows(spark, crowd, seed):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("abcd é") for _ in range(rng.randrange(120))) for _ in range(6)]
    texts = []
    for _ in range(120):
        pieces = [rng.choice(parts)[rng.randrange(20) :] if rng.random() < 0.5 else rng.choice("xyz") * rng.randrange(30) for _ in range(rng.randrange(6))]
        texts.append((rng.choice([None, *range(100)]), "".join(pieces)))
    texts += [(500, "a" * 90), (501, "ab" * 50), (502, "x" * 39), (503, parts[0] * 3), (503, parts[0] * 3), (504, None), (505, "")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = results(S.remove_repeated(frame, length=40, gram=12, crowd=crowd))
    assert counted(got) == counted(expected(texts, 40))


def test_long_texts_are_read_in_pieces(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 9000).astype(np.uint8)
    stops = np.array([3000, 3000, 3010, 9000])
    whole = S.anchors(data, stops, 60, 20)
    monkeypatch.setattr(S, "PIECE", 500)
    split = S.anchors(data, stops, 60, 20)
    # Ties of the first 32 bits apart, which the pieces see alike, the anchors are the same.
    assert whole[0].tolist() == split[0].tolist()


def test_column_order_by_comparing_pairs():
    rng = random.Random(6)
    strings, lefts, groups = [], [], []
    for group in range(4):
        core = "".join(rng.choice("ab") for _ in range(8)).encode()
        for _ in range(12):
            left = "".join(rng.choice("ab") for _ in range(rng.randrange(4))).encode()
            right = "".join(rng.choice("ab") for _ in range(rng.randrange(4))).encode()
            strings.append(left + core + right)
            lefts.append(len(left))
            groups.append(group)
    found = S.repeated_windows(strings, np.array(lefts), np.array(groups), length=11, gram=8)
    for i, string in enumerate(strings):
        for column in range(4):
            start = lefts[i] - (3 - column)
            window = string[start : start + 11] if start >= 0 else b""
            if len(window) < 11:
                continue
            others = [strings[j][lefts[j] - (3 - column) :][:11] for j in range(len(strings)) if j != i and groups[j] == groups[i] and lefts[j] >= 3 - column]
            assert found[i, column] == (window in others)


def test_corners(spark):
    docs = corner_docs(spark)
    done = S.remove_repeated(docs)
    assert set(done.columns) == (set(docs.columns) - {"text"}) | {"n_bytes", "spans", "kept"}
    assert counted(results(done)) == counted(expected([t for t in TEXTS], S.LENGTH))
    assert S.remove_repeated(no_docs(spark)).count() == 0


def test_planted_passages_are_removed_and_clean_texts_kept(spark):
    """Judged by ``n_removed``: ``n_bytes`` is the length of the input and can't show a removal."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(8))
    passages = [" ".join(word() for _ in range(60)) for _ in range(5)]  # 539 bytes each
    short = " ".join(word() for _ in range(40))  # 359 bytes: below the contract's 400
    texts = [" ".join([word(), word(), *([passages[i % 5]] if i < 20 else [short] if i < 30 else []), word()]) for i in range(40)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    removed = {r[0]: r[2] for r in results(S.remove_repeated(frame))}
    assert all(removed[i] >= 539 for i in range(20)) and all(removed[i] == 0 for i in range(20, 40))
