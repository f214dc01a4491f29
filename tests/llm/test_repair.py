import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from pagemill.llm import repair
from pagemill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def least_by_table(steps, forced_states=((0,), (0, 3))):
    """All nodes in order of rows, insertions closed by repeated passes; labels are (cost, audit)."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def closed(labels):
        for _ in range(4):
            for (s, r), to in after.items():
                if r != "s" and s in labels:
                    label = (labels[s][0] + 3, labels[s][1] + "I")
                    labels[to] = min(labels.get(to, label), label)
        return labels

    labels = closed({s: (0, "") for s in forced_states[0]})
    for initial, forced, cut in steps:
        new = {}
        for s, (cost, audit) in labels.items():
            options = [(s, 4, "D")]
            if not forced:
                options += [(to, (0 if r == initial else 3) + 3 * cut, "K" if r == initial else "R") for (a, r), to in after.items() if a == s and (r != "s" or initial == "s")]
            for to, price, letter in options:
                label = (cost + price, audit + letter)
                new[to] = min(new.get(to, label), label)
        labels = closed(new)
    return min((labels[s] for s in forced_states[1] if s in labels), default=None)


def expected(rows, damage):
    """``{conv: NAMES}`` of rows (conv, turn, role, text), one conversation at a time."""
    convs = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, steps, counts = set(), [], {"b": 0, "d": 0, "t": 0}
        for _, role, text in mine:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = "b" if not last else "d" if (role, text) in seen else "t" if last[0] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            steps.append((role[:1], fault in ("b", "d"), fault == "t"))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(mine, mine[1:])]
        turns = [t for t, *_ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = least_by_table(steps) if mine else (0, "")
        system, left, lines = (len(audit) - audit.count("D")) % 2, iter(mine), []
        for letter in audit:
            row = next(left) if letter != "I" else None
            if letter != "D":
                role = row[1] if letter == "K" else ("user", "assistant")[(len(lines) - system) % 2]
                lines.append(f"{role}:{row[2] if row else ''}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, counts["b"], counts["d"], counts["t"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)
    return out


def result(found):
    rows = found.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in rows}


def as_query(spark, rows, damage=True):
    """The query over rows of a test."""
    import tempfile

    folder = tempfile.mkdtemp()
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return result(QUERIES["op12_repair"](spark, folder))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query(spark, sf):
    folder = SF.replace("sf0.001", sf)
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(QUERIES["op12_repair"](spark, folder)) == expected(rows, True)


def test_paths_of_all_short_conversations():
    kinds = [("s", False, False), ("u", False, False), ("a", False, True), ("x", False, False), ("u", True, False)]
    for size in range(5):
        for steps in product(kinds, repeat=size):
            assert repair.least_path(steps, [0], (0, 3)) == least_by_table(steps)


def test_paths_of_random_conversations_whole_and_joined():
    rng = random.Random(4)
    for size in [9, 17, 40, 120]:
        steps = [(rng.choice("suauaua x"), rng.random() < 0.15, rng.random() < 0.2) for _ in range(size)]
        whole = repair.least_path(steps, [0], (0, 3))
        assert whole == least_by_table(steps)
        cuts = sorted(rng.sample(range(1, size), 3))
        parts = [repair.all_paths(steps[a:b]) for a, b in zip([0, *cuts], [*cuts, size])]
        paths = parts[0]
        for p in parts[1:]:
            paths = repair.joined_paths(paths, p)
        assert min(paths[0, e] for e in (0, 3) if (0, e) in paths) == whole
        for a, b in product(range(4), repeat=2):
            assert paths.get((a, b)) == least_by_table(steps, ((a,), (b,)))


def hot_rows(seed):
    rng = random.Random(seed)
    said = ["Yes.", "No", "Why?", " \t", "", "Well, then!", None, "…", "x" * 3000 + "."]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(said)) for c in (1, 2, 3, None) for t in range(rng.randrange(1, 9))]
    rows += [(7, t // 2 if t % 7 else None, rng.choice(["user", "assistant"]), rng.choice([*said, f"Answer {t}.", f"Word {t}"])) for t in range(400)]
    rows += [(8, 5, "user", "The same row.")] * 300 + [(9, None, "user", "No turn."), (9, None, None, None)]
    return rows


@pytest.mark.parametrize("piece, fan", [(1024, 32), (5, 2)])
def test_long_conversations_and_odd_rows(spark, monkeypatch, piece, fan):
    monkeypatch.setattr(repair, "PIECE_ROWS", piece)
    monkeypatch.setattr(repair, "FAN", fan)
    rows = hot_rows(piece)
    assert as_query(spark, rows) == expected(rows, True)


def test_repair_alone(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 2, "assistant", "Hello."), (1, 3, "user", "Cut off"), (2, 0, "user", " ")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'own' AS conv", "'own' AS audit", "'own' AS copies")
    done = repair.repair(frame)
    audits = {r.conv: r for r in done.audits.collect()}
    assert (audits[1].gaps, audits[1].truncated, audits[1].audit, audits[1].cost) == (1, 1, "KIKD", 7)
    assert audits[2].audit == "D" and audits[2].blank == 1
    turns = {r.conv: [tuple(t) for t in r.turns] for r in done.parts.collect()}
    assert turns == {1: [("system", "Be kind."), ("user", ""), ("assistant", "Hello.")], 2: []}
    empty = repair.repair(frame.limit(0))
    assert empty.audits.count() == 0 and empty.parts.count() == 0


def test_no_rows(spark):
    assert as_query(spark, []) == {}
    dropped = next((c, t) for c in range(99) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    got = as_query(spark, [(*dropped, "user", "Gone.")])
    assert got == {dropped[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
