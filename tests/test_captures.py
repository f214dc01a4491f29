"""Large lists in byte ranges against the reader that takes a file as one text."""

import json
import random

import pytest

from pagemill.sources import captures, readers

BROKEN = ['[{"a":1},]', '[{"a":1}', '{"a":1}]', '[1][2]', '[{"a":1]}', '[1}', '[{"url":"x"} {"url":"y"}]', "[,]", '["open]', "x", "", '[1] x{"a":2}', "]["]
SOUND = ["[]", " [ ] ", "7", '"x"', ' {"url":"u","network_requests":[{"b":"}{,]["}]} ', '[[{"url":1}],2]', '[1, "a,{]", null, {"url":"z","network_requests":[1,2]}]\n']


def big(seed):
    rng = random.Random(seed)
    odd = ['{', '}', '[', ']', ',', '"', '\\', '\\"', "é{", " ", "\n", "a" * 40, "\\\\{"]
    text = lambda: "".join(rng.choice(odd) for _ in range(rng.randrange(12)))
    bundles = [{"url": text(), "network_requests": [{"k": text(), "n": [i, {"d": {}}]} for i in range(rng.randrange(6))]} for _ in range(300)]
    return json.dumps([rng.choice([b, b, b, 5, text()]) for b in bundles], ensure_ascii=False, indent=rng.choice([None, 1]))


def rows(df):
    return sorted((r.file.rsplit("/", 1)[1], r.bundle_no, r.page_url or "", r.event_no, r.event.toJson()) for r in df.collect())


@pytest.mark.parametrize("chunk", [50, 1 << 20])
def test_lists_in_ranges_are_those_read_whole(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(captures, "CHUNK_CHARS", chunk)
    texts = [*BROKEN, *SOUND, big(1), big(2), big(3)[:-1], big(4).replace("network_requests", 'network"requests', 1)]
    for i, text in enumerate(texts):
        (tmp_path / f"{i:03d}.json").write_bytes(text.encode())
    expected = rows(readers.load_captures(spark, str(tmp_path)))
    assert {r[0] for r in expected} == {f"{i:03d}.json" for i in range(len(texts)) if i in (17, 19, 20, 21)} and len(expected) > 500
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert (tmp_path / "020.json").stat().st_size > 16 * 2048
        assert rows(readers.load_captures(spark, str(tmp_path), large=True)) == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_what_a_part_does():
    for seed in range(20):
        text, inside, depth = big(seed), False, 0
        marks = [i for i, c in enumerate(text) if c == "{"]
        cuts = [0, *sorted(random.Random(seed).sample(marks[1:], 9)), len(text)]
        held = []
        for a, b in zip(cuts, cuts[1:]):
            found = list(captures.fields(iter([text[a:b]]), True, inside, depth))
            inside, more = captures.passed(text[a:b], inside)
            depth += more
            for ended, _, piece in found:
                held.append(piece) if not held or held[-1] is None else held.__setitem__(-1, held[-1] + piece)
                if ended:
                    held.append("")
        assert not inside and depth == 0
        assert [json.loads(t) for t in held[1:-1]] == json.loads(text)
