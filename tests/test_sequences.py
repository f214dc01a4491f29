"""Numbering, packing, lookups and sessions on skewed inputs, against plain loops."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pagemill.operators import batches, ordering, records, relevance, sessions


def skewed(spark, n, seed=1):
    """A third of all rows in one group, sparse and uneven order values, one null group."""
    rng = random.Random(seed)
    order = sorted(rng.sample(range(n * 50), n), key=lambda x: x)
    rows = [(rng.choice(["hot"] * 4 + ["a", "b", "c", "d", "e", "f", "g", None]), o**2 % 10**9 * 1000 + i, rng.randrange(9)) for i, o in enumerate(order)]
    return spark.createDataFrame(rows, "g string, o long, x long"), rows


@pytest.mark.parametrize("rows", [10**6, 37])
@pytest.mark.parametrize("group", [[], ["g"]])
def test_running_sums(spark, rows, group):
    frame, _ = skewed(spark, 600)
    got = ordering.with_running_sums(frame, "o", {"total": F.col("x"), "n": F.lit(1)}, group, rows)
    window = Window.partitionBy(*group).orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    expected = frame.select("*", F.sum("x").over(window).alias("total"), F.sum(F.lit(1)).over(window).alias("n"))
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("rows", [10**6, 37])
def test_previous(spark, rows):
    frame, _ = skewed(spark, 600, 2)
    got = ordering.with_previous(frame, "o", "x", "before", ["g"], rows)
    expected = frame.withColumn("before", F.lag("x").over(Window.partitionBy("g").orderBy("o")))
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def greedy(items, limit):
    """The plain loop: (id, batch) of the packed items."""
    out, total, batch = [], None, -1
    for ident, size in items:
        if size > limit:
            continue
        if total is None or total + size >= limit:
            batch, total = batch + 1, size
        else:
            total += size
        out.append((ident, batch))
    return out


def test_packing_edge_cases(spark):
    sizes = [60, 39, 1, 101, 100, 5]
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "id long, tokens long")
    got = {r["id"]: r["batch_no"] for r in batches.pack_batches(frame, [], "id", 100).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 4: 2, 5: 3}


@pytest.mark.parametrize("piece_rows, limit", [(3, 100), (40, 1), (40, 10), (40, 100), (10**6, 10)])
def test_packing_in_pieces_is_the_plain_loop(spark, piece_rows, limit):
    rng = random.Random(limit * 7 + piece_rows)
    rows = [(rng.choice(["hot", "hot", "a", "b"]), i, rng.choice([0, 0, 1, 3, 9, 10, 40, 99, 100, 101])) for i in range(400)]
    frame = spark.createDataFrame(rows, "g string, id long, tokens long")
    got = batches.pack_batches(frame, ["g"], "id", limit, piece_rows=piece_rows)
    assert got.columns[:3] == ["g", "id", "tokens"]
    packed = got.collect()
    for group in ("hot", "a", "b"):
        mine = sorted((r["id"], r["batch_no"]) for r in packed if r["g"] == group)
        assert mine == greedy([(i, t) for g, i, t in rows if g == group], limit)


def test_packing_without_groups_in_pieces(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice([0, 1, 7, 30, 50, 51])) for i in range(200)]
    frame = spark.createDataFrame(rows, "id long, tokens long")
    got = batches.pack_batches(frame, [], "id", 50, piece_rows=30).collect()
    assert sorted((r["id"], r["batch_no"]) for r in got) == greedy(rows, 50)


@pytest.mark.parametrize("at_once, group", [(4, True), (64, False)])
def test_packing_composes_pieces_as_a_tree(spark, monkeypatch, at_once, group):
    monkeypatch.setattr(batches, "PIECES_AT_ONCE", at_once)
    seen = spark.sparkContext.accumulator(0)
    real, rng = batches._compose, random.Random(at_once)
    monkeypatch.setattr(batches, "_compose", lambda a, b: (seen.add(1), real(a, b))[1])
    rows = [("x" if group and i % 7 == 0 else None, i, rng.choice([0, 1, 1, 2, 3, 7, 30, 50, 51])) for i in range(600)]
    frame = spark.createDataFrame(rows, "g string, id long, tokens long")
    got = batches.pack_batches(frame, ["g"] if group else [], "id", 50, piece_rows=10).collect()
    for name in ("x", None) if group else (None,):
        mine = sorted((r["id"], r["batch_no"]) for r in got if r["g"] == name)
        assert mine == greedy([(i, t) for g, i, t in rows if g == name], 50)
    assert (seen.value > 0) or at_once == 64


def test_composed_courses_are_the_courses_of_both():
    rng = np.random.default_rng(6)
    for _ in range(300):
        limit = int(rng.integers(1, 30))
        first, second = (rng.integers(0, min(limit, 6) + 1, size=int(rng.integers(1, 9))) for _ in range(2))
        both = batches._describe(np.concatenate([first, second]), limit).sort_values("least_sum", kind="stable")
        made = batches._compose(batches._describe(first, limit), batches._describe(second, limit))
        sums = np.arange(-1, limit)
        assert [x.tolist() for x in batches._follow(made, sums)] == [x.tolist() for x in batches._follow(both, sums)]


def test_pack_courses_cover_every_entry():
    rng = np.random.default_rng(5)
    for _ in range(200):
        limit = int(rng.integers(1, 30))
        tokens = rng.integers(0, limit + 1, size=int(rng.integers(1, 25)))
        found = batches._describe(tokens, limit).sort_values("least_sum", kind="stable")
        for entry in range(-1, limit + 1):
            course = found[found["least_sum"] <= entry].iloc[-1] if entry >= 0 else found.iloc[0]
            total, opened = (None if entry < 0 else entry), 0
            for size in tokens:
                if total is None or total + size >= limit:
                    opened, total = opened + 1, int(size)
                else:
                    total += int(size)
            end = int(course["end_sum"]) + (0 if course["opened"] else entry)
            assert (int(course["opened"]), end) == (opened, total)


@pytest.mark.parametrize("rows", [10, 10**6])
def test_fixed_batches_in_pieces(spark, rows):
    frame = spark.createDataFrame([(i * 7, f"t{i}") for i in range(95)], "id long, text string")
    numbered = ordering.with_index(frame, "id", rows=rows)
    assert sorted(r["index"] for r in numbered.collect()) == list(range(95))
    made = batches.fixed_batches(frame, "text", "id", 10, "|", rows).orderBy("batch_no").collect()
    assert [r["n"] for r in made] == [10] * 9 + [5]
    assert made[1]["batch_text"] == "|".join(f"t{i}" for i in range(10, 20))


@pytest.mark.parametrize("rows", [7, 100, 10**6])
def test_ties_keep_every_row(spark, rows):
    items = [("g" if i % 3 else None, i // 4, f"t{i}") for i in range(300)]
    frame = spark.createDataFrame(items, "g string, o long, text string")
    whole = ordering.with_index(frame, "o", rows=rows).collect()
    assert sorted(r["index"] for r in whole) == list(range(300))
    assert all(a["o"] <= b["o"] for a, b in zip(*[iter(sorted(whole, key=lambda r: r["index"]))] * 2))
    grouped = ordering.with_index(frame, ["o", "text"], ["g"], rows=rows).collect()
    for group in ("g", None):
        mine = sorted((r["index"], r["o"], r["text"]) for r in grouped if r["g"] == group)
        expected = sorted((o, t) for g, o, t in items if g == group)
        assert mine == [(i, *e) for i, e in enumerate(expected)]
    made = batches.fixed_batches(frame, "text", "o", 7, "|", rows).collect()
    assert sum(r["n"] for r in made) == 300
    assert sorted(t for r in made for t in r["batch_text"].split("|")) == sorted(t for _, _, t in items)


@pytest.mark.parametrize("piece_rows", [20, 10**6])
def test_packing_keeps_ties(spark, piece_rows):
    rows = [("a", i // 5, [3, 3, 9, 1, 40][i % 5], f"t{i}") for i in range(200)]
    frame = spark.createDataFrame(rows, "g string, id long, tokens long, text string")
    got = batches.pack_batches(frame, ["g"], "id", 50, piece_rows=piece_rows)
    assert got.columns == ["g", "id", "tokens", "text", "batch_no"]
    packed = got.collect()
    assert sorted(r["text"] for r in packed) == sorted(t for _, _, _, t in rows)
    plain = greedy([((i, s), s) for _, i, s, _ in sorted(rows)], 50)
    assert sorted(((r["id"], r["tokens"]), r["batch_no"]) for r in packed) == sorted(plain)


@pytest.mark.parametrize("limit_bytes, hot_keys", [(0, 1), (0, 3), (8 << 20, 3)])
def test_lookup_join_split(spark, monkeypatch, limit_bytes, hot_keys):
    monkeypatch.setattr(ordering, "BROADCAST_BYTES", limit_bytes)
    monkeypatch.setattr(ordering, "HOT_KEYS", hot_keys)
    frame, rows = skewed(spark, 500, 3)
    lookup = frame.groupBy("g").agg(F.max("x").alias("top"), F.count("*").alias("_n"))
    got = ordering.lookup_join(frame, lookup, "g")
    top = {}
    for g, _, x in rows:
        top[g] = max(top.get(g, 0), x)
    assert sorted(map(str, [tuple(r) for r in got.collect()])) == sorted(str((*r, top[r[0]])) for r in rows)


def test_until_stop_keeps_what_is_before(spark, monkeypatch):
    monkeypatch.setattr(ordering, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(ordering, "HOT_KEYS", 1)
    rows = [("a", i, i == 3) for i in range(6)] + [("b", 1, None), ("b", 2, False), ("c", 1, True), (None, 1, False)]
    frame = spark.createDataFrame(rows, "site string, page long, stop boolean")
    got = records.until_stop(frame, "site", "page", F.col("stop"))
    assert sorted((r["site"] or "", r["page"]) for r in got.collect()) == [("", 1), ("a", 0), ("a", 1), ("a", 2), ("b", 1), ("b", 2)]


def test_gap_equal_to_the_limit_continues(spark):
    rows = [("k", t) for t in (0, 4000, 8001, 8001, 20000)]
    frame = spark.createDataFrame(rows, "k string, ms long").select("k", F.timestamp_millis("ms").alias("ts"))
    got = sessions.idle_sessions(frame, "k", gap_ms=4000).orderBy("session_no").collect()
    assert [r["n_events"] for r in got] == [2, 2, 1]
    assert [(r["idle_at"] - r["session_end"]).total_seconds() for r in got] == [4.0] * 3


@pytest.mark.parametrize("seed", range(2))
def test_sessions_are_the_plain_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("hhhha"), rng.randrange(0, 40_000)) for _ in range(300)]
    frame = spark.createDataFrame(rows, "k string, ms long").select("k", F.timestamp_millis("ms").alias("ts"))
    got = sorted((r["k"], r["n_events"], r["session_start"]) for r in sessions.idle_sessions(frame, "k", gap_ms=150).collect())
    expected = []
    for key in "ha":
        last, session = None, None
        for moment in sorted(t for k, t in rows if k == key):
            if last is None or moment - last > 150:
                session = [key, 0, moment]
                expected.append(session)
            session[1] += 1
            last = moment
    assert [(k, n, int(s.timestamp() * 1000 + 0.5)) for k, n, s in got] == sorted(map(tuple, expected))


@pytest.mark.parametrize("span_slots", [1, 3, 50])
def test_sessions_over_spans_are_the_plain_loop(spark, span_slots):
    rng = random.Random(span_slots)
    moments = sorted({rng.randrange(-30_000, 30_000) for _ in range(400)})
    rows = [(rng.choice(["h", "h", None]), t) for t in moments] + [("h", t) for t in range(40_000, 60_000, 90)]
    frame = spark.createDataFrame(rows, "k string, ms long").select("k", F.timestamp_millis("ms").alias("ts"))
    found = sessions.idle_sessions(frame, "k", gap_ms=100, span_slots=span_slots).collect()
    got = sorted((r["k"] or "", r["session_no"], r["n_events"], round(r["session_start"].timestamp() * 1000), round(r["session_end"].timestamp() * 1000)) for r in found)
    expected = []
    for key in ("h", None):
        last, session, number = None, None, 0
        for moment in sorted(t for k, t in rows if k == key):
            if last is None or moment - last > 100:
                number += 1
                session = [key or "", number, 0, moment, moment]
                expected.append(session)
            session[2] += 1
            session[4] = last = moment
    assert got == sorted(map(tuple, expected))


def test_adaptive_stats_do_not_depend_on_pieces(spark, monkeypatch):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(30)]
    rows = [(rng.choice(["s", "s", "t"]), i * 3, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 12)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "crawl string, id long, text string")
    whole = relevance.adaptive_stats(docs, ["w1", "w2"], "crawl", "id")
    one = sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in whole.collect())
    real = relevance.cut_points
    monkeypatch.setattr(relevance, "cut_points", lambda df, order: real(df, order, 11))
    split = relevance.adaptive_stats(docs, ["w1", "w2"], "crawl", "id")
    assert one == sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in split.collect())


def test_order_must_be_numeric(spark):
    with pytest.raises(ValueError, match="numeric"):
        ordering.with_index(spark.createDataFrame([("a",)], "id string"), "id")


def test_sizes_and_courses_are_not_broadcast(spark, monkeypatch):
    """Sizes and courses that repeat take a byte or two a row in a file; by its size they were sent through the driver."""
    monkeypatch.setattr(batches, "PIECES_AT_ONCE", 4)
    real, plans = batches.null_safe_join, []

    def join(*args):
        found = real(*args)
        if {"_block", ordering.PIECE, "_tie"} & set(args[2]):
            plans.append(re.search(r"\w+Join", found._jdf.queryExecution().executedPlan().toString()).group())
        return found

    monkeypatch.setattr(batches, "null_safe_join", join)
    rows = [("x", i, 1 + i % 3) for i in range(300)]
    got = batches.pack_batches(spark.createDataFrame(rows, "g string, id long, tokens long"), ["g"], "id", 50, piece_rows=10).collect()
    assert sorted((r["id"], r["batch_no"]) for r in got) == greedy([(i, t) for _, i, t in rows], 50)
    assert set(plans) == {"SortMergeJoin"}  # the last join
