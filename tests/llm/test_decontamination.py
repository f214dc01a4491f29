import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from pagemill.llm import decontamination as D
from pagemill.llm.queries import QUERIES
from tests.llm.corners import TEXTS, corner_docs, no_docs

SF = "/root/testdata/sf0.01"
QUESTION = "A farmer named Jones has 12 cows and buys 7 more cows for 300 dollars from his friend Miller, how many cows does Jones own now?"
OTHER = "A farmer named Smith has 45 cows and buys 9 more cows for 800 euros from his friend Baker, how many cows does Smith own now?"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(spark, docs, bench):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return sorted((r.doc_id, r.item_id, r.verbatim) for r in D.leaks(frame, items(spark, bench)).collect())


def test_query_finds_what_is_in_the_texts(spark):
    def plain(text):
        return " ".join(text.lower().split())

    docs = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    bench = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    expected = {(d, i) for d, t in docs.items() for i, b in bench.items() if b in t}
    rows = QUERIES["op9_decontamination"](spark, SF).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == expected and len(rows) == len(expected)
    assert all(r.verbatim and r.share >= D.SHARE and r.matched <= r.windows for r in rows)


def test_templates_and_slots(spark):
    mixed = OTHER.replace("does Smith own", "does Brown own")
    docs = [(1, f"Before it. {OTHER} After it."), (2, mixed), (3, QUESTION.upper()), (4, "cows and more cows " * 50), (5, f"{QUESTION} {OTHER}")]
    assert found(spark, docs, [(1, QUESTION)]) == [(1, 1, False), (3, 1, True), (5, 1, True)]


def test_share_and_places(spark):
    words = [f"word{c}x" for c in "abcdefghijklmnopqrstuvwxyz"]
    item = " ".join(words)
    nearly = " ".join([*words[:12], "extra", *words[12:]])
    half = " ".join(words[:13])
    scattered = " ".join(f"{' '.join(words[i : i + 5])} {'filler ' * 60}" for i in range(0, 26, 5))
    twice = f"{item} {item}"
    docs = [(1, item), (2, nearly), (3, half), (4, scattered), (5, twice), (6, item), (6, item)]
    assert found(spark, docs, [(9, item), (9, item), (10, None), (11, "too short")]) == [(1, 9, True), (2, 9, True), (5, 9, True), (6, 9, True)]


def test_a_full_filter_changes_nothing(spark):
    frame, bench = spark.createDataFrame([(1, OTHER), (2, "nothing of it is in here at all")], "doc_id long, text string"), items(spark, [(1, QUESTION)])
    for bits in (6, 25):
        assert sorted((r.doc_id, r.item_id, r.verbatim) for r in D.leaks(frame, bench, bits=bits).collect()) == [(1, 1, False)]


def test_short_items(spark):
    bench = [(1, "Open Sesame!"), (2, "12 kg"), (3, "..."), (4, "word")]
    docs = [(1, "he said open, sesame"), (2, "it is 12 kg now"), (3, "it is 13 kg, open it"), (4, "sesame open"), (5, "a Word")]
    assert found(spark, docs, bench) == [(1, 1, True), (2, 2, True), (5, 4, True)]


TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*")


def test_words_are_those_of_a_pattern():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("aB'’.,:1 29\tÉéß漢🙂Σ_-!\"”)…\n") for _ in range(rng.randrange(40)))
        words = D.words_of(text)
        found = [text[a:b] for a, b in zip(words.starts, words.ends)]
        assert found == [t for t in TOKEN.findall(text.replace("🙂", "字"))] or "🙂" in text
        kinds = [D.DIGITS if w[0].isdigit() else D.CAPITAL if w[0].isupper() and w[1:].islower() else D.PLAIN for w in found]
        assert (words.codes & np.uint64(3)).tolist() == kinds or "'" in text or "’" in text or "ß" in text
        ends = []
        for unit in text.split():
            own = TOKEN.findall(unit.replace("🙂", "字"))
            ends += [False] * (len(own) - 1) + [unit.rstrip("\"'”’)").endswith((".", "!", "?", ":", "…"))] * bool(own)
        assert [bool(c & np.uint64(D.ENDS)) for c in words.codes] == ends
    a, b, c = D.words_of("Word WORD"), D.words_of("xx word"), D.words_of("wrod w'ord")
    assert len({int(x) & D.CODE for x in (*a.codes, b.codes[1])}) == 1 and len({int(x) & D.CODE for x in (a.codes[0], *c.codes)}) == 3


def test_texts_in_pieces():
    text = " ".join([QUESTION, "... -- ?!", OTHER, "No. 12 kg 5 Ben", "x" * 90, QUESTION.upper()]) * 3
    expected = sorted(map(repr, zip(*D.group_windows([D.Segment(0, text)], None, [2]), strict=True)))
    for size in (1, 7, 50, 333, 1 << 20):
        got = [w for group in D.segment_groups([text, None, ""], size) for w in zip(*D.group_windows(group, None, [2]), strict=True)]
        assert sorted(map(repr, got)) == expected


def test_a_long_list_of_numbers_takes_no_minutes():
    start = time.perf_counter()
    numbers = [(w, o - w, [("1", "1")]) for w in range(120) for o in range(120)]
    assert D.aligned(numbers, 96) == (120, True)
    assert time.perf_counter() - start < 5


def test_corners(spark):
    docs, bench = corner_docs(spark), items(spark, [(1, TEXTS[0][1]), (None, QUESTION), (2, "")])
    kept = D.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.filter(F.col("doc_id").isNotNull()).collect()) == [3, 4, 5, 6, 7, 8, 9]
    assert D.leaks(no_docs(spark), bench).count() == 0 and D.leaks(docs, bench.limit(0)).count() == 0
    assert D.drop_leaks(docs, bench.limit(0)).count() == len(TEXTS)
    assert D.drop_leaks(docs.union(spark.createDataFrame([(None, QUESTION)], "d long, t string").select("d", "t", *docs.columns[2:]) if False else no_docs(spark)), bench).count() == 9


REPEATS = {
    1: ("which number comes next in the sequence 2 4 8 16 32 64 128 256 of powers", "which number comes next in the sequence 3 9 27 81 243 729 2187 6561 of powers"),
    2: (
        "on monday we saw that Anna, Ben, Carl, Dora, Emil, Fred and the teacher left the room early",
        "on monday we saw that Gina, Hugo, Ida, Jan, Kim, Lars and the teacher left the room early",
    ),
    3: ("the man sells 3 boxes of red pens for anna 5 boxes of red pens for ben", "the man sells 7 boxes of red pens for anna 9 boxes of red pens for ben"),
}


def test_windows_that_an_item_repeats(spark):
    bench = [(i, text) for i, (text, _) in REPEATS.items()]
    docs, expected = [], []
    for i, texts in REPEATS.items():
        for verbatim, text in zip((True, False), texts, strict=True):
            for before in range(0, 30, 3):
                docs.append((len(docs), f"{'filler ' * before}{text} and so on"))
                expected.append((len(docs) - 1, i, verbatim))
    assert found(spark, docs, bench) == expected


def test_edited_copies_of_repeating_items(spark):
    sequence = REPEATS[1][0]
    mixed = "which number comes next in the sequence 3 9 27 81 243 729 2187 6561 of powers if the first number is 2 and the last is 256"
    docs = [
        (1, sequence.replace("in the", "in the long")),  # the numbers stand one place further on
        (2, sequence.replace("256 of powers", "and more powers")),  # the last windows are found at the place of others only
        (3, mixed.replace("is 2 and", "is 5 and")),  # 2 became 3 and 5
        (4, mixed),
    ]
    item = sequence + " if the first number is 2 and the last is 256"
    long = " ".join(["please tell me as soon as you can what you think about it:", sequence, "and then say why you think that it must be so"])
    texts = [(d, long.replace(sequence, t)) for d, t in docs[:2]]
    assert found(spark, texts, [(1, long)]) == [(1, 1, True), (2, 1, True)]
    assert found(spark, docs[2:], [(1, item)]) == []
