"""Line dedup: lines that are equal or at most ``MOST`` edits apart are one line.

Lines of under ``LEAST_CHARS`` letters are one only if they are equal, since two
edits change too much of them. The longer lines of all documents are joined with themselves by segments: a line is
cut into one segment more than there may be edits, so one segment is unchanged
in any line it is close to. Segments are hashed together with the length of
their line and their number, longer lines are probed at the starts that leave
enough edits on either side, and every pair that meets is verified by its edit
distance. Close lines are linked, and a class of lines is what links reach.

The keys are sorted, and lines that stand under one key meet there. Under a key
with more than ``CROWD`` lines they don't: up to ``GROUP`` lines are compared in
the task, by letter counts first, and only close ones are passed on. Of more
lines the segment is taken out, and the rests, which still may differ by the
same number of edits, are cut into segments again, at places that give every
segment a like part of what differs between the lines of the key. This goes on
until no key is large or its indexed rests differ in no more letters than there may
be edits; those are all close, and a star links them. So no link is lost, and
lines with a long common part don't meet pairwise.

Lines are the parts of a text between line ends; white space around a line
doesn't count, and a line with nothing else is always kept. Of a
class the first line stays, by document key (null last), then by a hash of the
text, then by number. Null texts have no lines and stay null; empty texts stay
empty. Two rows with the same key and text are two documents; of their lines
both copies of a first line stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import md5
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, ByteType, IntegerType, LongType, StringType, StructField, StructType

from pagemill.llm.batches import chunks, free_name, values
from pagemill.llm.bits import bit_filter, may_hold
from pagemill.llm.components import components
from pagemill.llm.edits import INDEX, PROBE, distances, keys
from pagemill.operators.ordering import null_safe_join
from pagemill.session import ship_package
from pagemill.storage import cut_lineage

MOST = 2
LEAST_CHARS = 16
CROWD = 32
GROUP = 1_024
SAMPLE = 256  # rests of a large key by which the places to cut are chosen
LINES_AT_ONCE = 4_096
BLANK = " \t\r\x0b\x0c"

PLACE = ["last", "key", "text_hash", "line_no"]  # the order of first lines; ``last`` is true for a null key
LINES = [StructField("last", BooleanType()), StructField("text_hash", LongType()), StructField("line_no", IntegerType()), StructField("line", BinaryType())]
ENTRIES = StructType([StructField("key", LongType()), StructField("role", ByteType()), StructField("line", LongType())])
MET = StructType([StructField("a", LongType()), StructField("b", LongType()), *ENTRIES, StructField("rest", StringType())])
PAIR = StructType([StructField("a", LongType()), StructField("b", LongType())])
TEXTS = StructType([StructField("line", LongType()), StructField("text", StringType())])
DEEPER = StructType([*ENTRIES, StructField("rest", StringType())])
PAIRS = StructType([StructField("first", StringType()), StructField("second", StringType())])


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def lines_of(text: str | None, least: int) -> list[str]:
    """The lines that are compared by edits."""
    return [s for s in (raw.strip(BLANK) for raw in (text or "").split("\n")) if len(s) >= least]


def line_hash(line: str) -> int:
    """The same as Spark's ``xxhash64`` of the line."""
    return signed(xxhash.xxh64_intdigest(line.encode("utf-8", "replace"), 42))


def _batch(schema: pa.Schema, columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def entries(texts: DataFrame, most: int = MOST, least: int = LEAST_CHARS) -> DataFrame:
    """``key, role, line`` for every line of the column ``text``; ``line`` is a hash that only names candidates."""
    arrow = to_arrow_schema(ENTRIES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                found = list({s for t in values(part, "text") for s in lines_of(t, least)})
                for at in range(0, len(found), LINES_AT_ONCE):
                    rows = [(k, r, h) for s in found[at : at + LINES_AT_ONCE] for h in (line_hash(s),) for k, r, _, _ in keys(s, most)]
                    yield _batch(arrow, [list(c) for c in zip(*rows, strict=True)])

    return texts.select("text").mapInArrow(run, ENTRIES)


def cuts(rests: list[str], varied: list[int], most: int = MOST) -> list[int]:
    """Where rests of one length are cut: every segment has a column of ``varied``, and the letters differ about as much."""
    points = np.array([np.frombuffer(r.encode("utf-32-le", "surrogatepass"), np.uint32)[varied] for r in rests])
    alike = np.array([(np.unique(column, return_counts=True)[1] ** 2).sum() for column in points.T]) / len(rests) ** 2
    weight = np.cumsum(1e-3 - np.log(alike))
    ends = [int(np.searchsorted(weight, weight[-1] * i / (most + 1))) + 1 for i in range(1, most + 1)]
    for i in range(most):
        ends[i] = max(ends[i], ends[i - 1] + 1 if i else 1)
    for i in reversed(range(most)):
        ends[i] = min(ends[i], len(varied) - (most - i))
    return [0, *(varied[e] for e in ends), len(rests[0])]


def deeper(rows: DataFrame, most: int = MOST) -> DataFrame:
    """Keys of the rests below their old key, with what is left when the new segment is taken out as well.

    ``cuts`` has the segments of the indexed rests of the key, which have all
    the same length; rests that probe have up to ``most`` letters more.
    """
    arrow = to_arrow_schema(DEEPER)

    def below(parent: int, role: int, line: int, rest: str, ends: list[int]) -> Iterator[tuple[int, int, int, str]]:
        shift = len(rest) - ends[-1]
        for i, (start, stop) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            for move in range(max(-i, shift - (most - i), -start), min(i, shift + (most - i), len(rest) - stop) + 1):
                own = role if shift == 0 and move == 0 else role & PROBE
                if own:
                    a, b = start + move, stop + move
                    digest = xxhash.xxh64_intdigest(rest[a:b].encode("utf-8", "replace"), (parent * 31 + i) & 0xFFFFFFFFFFFFFFFF)
                    yield signed(digest), own, line, rest[:a] + rest[b:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "rest", 1 << 20):
                names = ("key", "role", "line", "rest", "cuts")
                found = [new for row in zip(*(values(part, c) for c in names), strict=True) for new in below(*row)]
                if found:
                    yield _batch(arrow, [list(c) for c in zip(*found, strict=True)])

    return rows.select("key", "role", "line", "rest", "cuts").mapInArrow(run, DEEPER)


def varied_columns(large: DataFrame) -> DataFrame:
    """``key, varied``: in which letters the indexed rests of a key differ."""
    schema = StructType([ENTRIES["key"], StructField("column", IntegerType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(values(batch, c) for c in ("key", "rest", "least")), strict=True)
            found = {(key, i) for key, rest, least in rows for i in range(len(rest)) if rest[i] != least[i]}
            if found:
                yield _batch(arrow, [list(c) for c in zip(*found, strict=True)])

    indexed = large.filter(_indexed()).select("key", "rest")
    least = indexed.groupBy("key").agg(F.min("rest").alias("least"))
    columns = indexed.join(least, "key").mapInArrow(run, schema).groupBy("key").agg(F.sort_array(F.collect_set("column")).alias("varied"))
    none = F.array().cast(ArrayType(IntegerType()))
    return least.select("key").join(columns, "key", "left").select("key", F.coalesce("varied", none).alias("varied"))


def chosen_cuts(large: DataFrame, most: int = MOST) -> DataFrame:
    """``key, cuts`` by a few of the indexed rests of every key."""
    schema = StructType([ENTRIES["key"], StructField("cuts", ArrayType(IntegerType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = zip(batch.column("rests"), values(batch, "varied"), strict=True)
                yield _batch(arrow, [values(batch, "key"), [cuts(r.as_py(), v, most) for r, v in found]])

    indexed = large.filter(_indexed())
    few = indexed.filter(F.pmod(F.xxhash64("line"), F.ceil(F.col("indexed") / SAMPLE)) == 0).select("key", "varied", "rest")
    one = indexed.groupBy("key", "varied").agg(F.min("rest").alias("rest"))
    return few.unionByName(one).groupBy("key", "varied").agg(F.collect_list("rest").alias("rests")).mapInArrow(run, schema)


def _indexed() -> Column:
    return F.col("role").bitwiseAND(F.lit(INDEX)) > 0


def alike_pairs(rows: DataFrame, most: int = MOST) -> DataFrame:
    """Pairs ``a, b`` under keys whose indexed rests differ in at most ``most`` letters, ``varied``.

    Those stand at the same places of their lines, so all these lines are close
    and the least is linked with each. Any other line under the key meets one
    indexed line for every way in which its letters can stand at those places;
    where an edit falls on such a place, the letter there doesn't matter.
    """
    schema = StructType([ENTRIES["key"], StructField("part", StringType()), StructField("line", LongType())])
    arrow = to_arrow_schema(schema)

    def parts(moves: range) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [
                    (key, "".join(part), line)
                    for key, line, rest, varied in zip(*(values(batch, c) for c in ("key", "line", "rest", "varied")), strict=True)
                    for part in product(*({"", *(f"{i}{rest[v + m]}" for m in moves if 0 <= v + m < len(rest))} for i, v in enumerate(varied)))
                ]
                if found:
                    yield _batch(arrow, [list(c) for c in zip(*found, strict=True)])

        return run

    indexed = rows.filter(_indexed()).select("key", "line", "rest", "varied")
    least = indexed.groupBy("key").agg(F.min("line").alias("a"))
    star = indexed.join(least, "key").select("a", F.col("line").alias("b")).filter("a <> b")
    others = rows.select("key", "line", "rest", "varied").join(indexed.select("key", "line"), ["key", "line"], "left_anti")
    one = indexed.mapInArrow(parts(range(1)), schema).groupBy("key", "part").agg(F.min("line").alias("a"))
    met = others.mapInArrow(parts(range(-most, most + 1)), schema).join(one, ["key", "part"])
    pairs = star.unionByName(met.select("a", F.col("line").alias("b")))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def opened(rows: DataFrame, most: int = MOST) -> DataFrame:
    """``key, role, line, text`` to the rest of each text below the keys that are its own."""
    arrow = to_arrow_schema(DEEPER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", 1 << 20):
                found = [
                    (wanted, own & role, line, text[:a] + text[b:])
                    for wanted, role, line, text in zip(*(values(part, c) for c in ("key", "role", "line", "text")), strict=True)
                    for key, own, a, b in keys(text, most)
                    if key == wanted and own & role
                ]
                if found:
                    yield _batch(arrow, [list(c) for c in zip(*found, strict=True)])

    return rows.select("key", "role", "line", "text").mapInArrow(run, DEEPER)


def meetings(rows: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Pairs ``a, b`` of lines under one key, one of them as indexed and the other as probed.

    The rows come sorted by key, so a task sees one key after the other and
    holds at most ``crowd`` lines of it. The lines of a key with more are passed
    on as they are, with ``key`` set and without a pair.
    """
    arrow = to_arrow_schema(MET)
    rest = "rest" in rows.columns

    def pairs(part: list[tuple[int, int]]) -> set[tuple[int, int]]:
        probed = [line for line, role in part if role & PROBE]
        return {(min(a, b), max(a, b)) for a, role in part if role & INDEX for b in probed if a != b}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, crowded = None, {}, False
        out: list[tuple] = []

        def close() -> None:
            if len(held) > 1 and not crowded:
                out.extend((a, b, None, None, None, None) for a, b in pairs([(line, role) for line, role, _ in held]))

        for batch in batches:
            keys_, lines_ = np.asarray(batch.column("key")), np.asarray(batch.column("line"))
            if not len(keys_):
                continue
            # A key that stands alone needs nothing; the last one may go on in the next batch.
            near = np.r_[False, keys_[1:] == keys_[:-1]]
            keep = near | np.r_[near[1:], True]
            keep[0] |= key is not None and keys_[0] == key
            at = np.flatnonzero(keep)
            roles = batch.column("role").take(pa.array(at)).to_pylist()
            rests = batch.column("rest").take(pa.array(at)).to_pylist() if rest else [None] * len(at)
            for k, line, role, left in zip(keys_[at].tolist(), lines_[at].tolist(), roles, rests, strict=True):
                if k != key:
                    close()
                    key, held, crowded = k, {}, False
                if (line, role, left) in held:
                    continue
                if crowded:
                    out.append((None, None, k, role, line, left))
                    continue
                held[(line, role, left)] = None
                if len(held) > crowd:
                    crowded = True
                    out.extend((None, None, k, r, n, t) for n, r, t in held)
            if len(out) > 20_000:
                yield _batch(arrow, [list(c) for c in zip(*out, strict=True)])
                out.clear()
        close()
        if out:
            yield _batch(arrow, [list(c) for c in zip(*out, strict=True)])

    dealt = rows.repartition("key").sortWithinPartitions("key", "line")
    return dealt.select("key", "role", "line", *(["rest"] if rest else [])).mapInArrow(run, MET)


def grouped_pairs(rows: DataFrame, most: int = MOST) -> DataFrame:
    """Pairs ``a, b`` of lines under one key whose rests are close; a key has at most ``GROUP`` lines.

    An edit changes the counts of two letters at most, so only lines whose
    letter counts differ by twice the edits are compared. Rests that are indexed
    stand at the same places of their lines, so if they are close, their lines
    are; of those pairs only the ones that connect something new are passed on.
    """
    arrow = to_arrow_schema(PAIR)

    def close(held: dict[tuple[int, str], int]) -> list[tuple[int, int]]:
        names, texts, roles = [n for n, _ in held], [t for _, t in held], list(held.values())
        counts = np.zeros((len(texts), 64), np.int32)
        for row, text in zip(counts, texts, strict=True):
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            row += np.bincount(points % 64, minlength=64).astype(np.int32)
        first, second = [], []
        for i in range(len(texts) - 1):
            near = np.flatnonzero(np.abs(counts[i + 1 :] - counts[i]).sum(1) <= 2 * most) + i + 1
            first += [i] * len(near)
            second += near.tolist()
        found = distances([texts[i] for i in first], [texts[j] for j in second], most) <= most
        root = list(range(len(names)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        pairs = []
        for k in np.flatnonzero(found).tolist():
            i, j = first[k], second[k]
            if roles[i] & roles[j] & INDEX:
                one, other = find(i), find(j)
                if one == other:
                    continue
                root[other] = one
            if names[i] != names[j]:
                pairs.append((min(names[i], names[j]), max(names[i], names[j])))
        return pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}
        for batch in batches:
            out = []
            for k, role, line, rest in zip(*(values(batch, c) for c in ("key", "role", "line", "rest")), strict=True):
                if k != key:
                    out += close(held)
                    key, held = k, {}
                held[line, rest] = held.get((line, rest), 0) | role
            if out:
                yield _batch(arrow, [list(c) for c in zip(*out, strict=True)])
        if out := close(held):
            yield _batch(arrow, [list(c) for c in zip(*out, strict=True)])

    dealt = rows.select("key", "role", "line", "rest").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, PAIR)


def close_lines(
    docs: DataFrame, column: str = "text", most: int = MOST, least: int = LEAST_CHARS, crowd: int = CROWD, group: int = GROUP
) -> DataFrame:
    """Links ``a, b`` between the MD5 of lines at most ``most`` edits apart.

    Lines that are close are connected through links, though not every close
    pair need be named. All lines of ``column`` are compared.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(column).alias("text")).filter(F.col("text").isNotNull())
    met = cut_lineage(meetings(entries(texts, most, least), crowd), "meetings")
    pairs = [met.filter("a IS NOT NULL").select("a", "b")]
    crowded = met.filter("key IS NOT NULL").select("key", "role", "line")
    if not crowded.isEmpty():
        crowded = cut_lineage(crowded.distinct(), "crowded")
        rows = crowded.join(_texts(texts, crowded.select("line").distinct(), least), "line").withColumnRenamed("text", "rest")
        whole = True
        while True:
            rows = cut_lineage(rows, "crowds")
            # Without an indexed line no two meet under a key.
            indexed = F.count(F.when(_indexed(), True)).alias("indexed")
            sizes = rows.groupBy("key").agg(F.countDistinct("line").alias("n"), indexed).filter("indexed > 0")
            sized = cut_lineage(rows.join(sizes, "key"), "sized-crowds")
            pairs.append(grouped_pairs(sized.filter(F.col("n") <= group), most))
            large = sized.filter(F.col("n") > group)
            if whole:
                # The first key is left standing in the line; it is taken out before anything is cut.
                rest = opened(large.withColumnRenamed("rest", "text"), most).distinct()
                indexed = rest.filter(_indexed()).groupBy("key").agg(F.count("*").alias("indexed"))
                large, whole = cut_lineage(rest.join(indexed, "key"), "opened-crowds"), False
            large = cut_lineage(large.join(cut_lineage(varied_columns(large), "columns"), "key"), "large-crowds")
            pairs.append(alike_pairs(large.filter(F.size("varied") <= most), most))
            large = large.filter(F.size("varied") > most)
            if large.isEmpty():
                break
            cut = large.join(cut_lineage(chosen_cuts(large, most), "cuts"), "key")
            met = cut_lineage(meetings(deeper(cut, most), crowd), "meetings")
            pairs.append(met.filter("a IS NOT NULL").select("a", "b"))
            rows = met.filter("key IS NOT NULL").select("key", "role", "line", "rest")
    met = cut_lineage(reduce(DataFrame.unionByName, pairs).distinct(), "pairs")
    named = cut_lineage(_texts(texts, met.select(F.col("a").alias("line")).union(met.select("b")).distinct(), least), "texts")
    left = named.select(F.col("line").alias("a"), F.col("text").alias("first"))
    right = named.select(F.col("line").alias("b"), F.col("text").alias("second"))
    # Sent to all cores by pair: verifying is the costly part.
    both = met.join(left, "a").join(right, "b").select("first", "second").repartition(F.xxhash64("first", "second"))
    return _verified(both, most)


def _texts(texts: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """``line, text`` of the lines with a hash in ``wanted``, each different text once.

    A filter of fixed size tells the tasks most of the lines that aren't wanted;
    what passes is joined.
    """
    wanted = cut_lineage(wanted, "wanted")
    shared = texts.sparkSession.sparkContext.broadcast(bit_filter(wanted, "line"))
    arrow = to_arrow_schema(TEXTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                found = list({s for t in values(part, "text") for s in lines_of(t, least)})
                hashes = np.array([line_hash(s) for s in found], np.int64)
                at = np.flatnonzero(may_hold(shared.value, hashes))
                if len(at):
                    yield _batch(arrow, [hashes[at], [found[i] for i in at]])

    return texts.select("text").mapInArrow(run, TEXTS).distinct().join(wanted, "line")


def _verified(pairs: DataFrame, most: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "first", 8 << 20):
                close = pa.array(distances(values(part, "first"), values(part, "second"), most) <= most)
                yield part.filter(close)

    kept = pairs.mapInArrow(run, PAIRS)
    return kept.select(F.unhex(F.md5(F.col("first").cast("binary"))).alias("a"), F.unhex(F.md5(F.col("second").cast("binary"))).alias("b"))


def line_places(docs: DataFrame, key: str, column: str) -> DataFrame:
    """``last, key, text_hash, line_no`` and the MD5 of every line that isn't blank."""
    rows = docs.select(F.col(key).isNull().alias("last"), F.col(key).alias("key"), F.xxhash64(column).alias("text_hash"), F.col(column).alias("text"))
    schema = StructType([LINES[0], rows.schema["key"], *LINES[1:]])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                row, number, digest = [], [], []
                for i, text in enumerate(values(part, "text")):
                    for k, raw in enumerate((text or "").split("\n")):
                        line = raw.strip(BLANK)
                        if line:
                            row.append(i)
                            number.append(k)
                            digest.append(md5(line.encode("utf-8", "replace")).digest())
                if row:
                    owner = [part.column(c).take(pa.array(row)) for c in ("last", "key", "text_hash")]
                    columns = [*owner, pa.array(number, pa.int32()), pa.array(digest, pa.binary())]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return rows.mapInArrow(run, schema)


def line_classes(docs: DataFrame, key: str = "doc_id", column: str = "text", most: int = MOST, least: int = LEAST_CHARS) -> DataFrame:
    """Every line that isn't blank with the first line of its class.

    ``last, key, text_hash, line_no`` say which line it is (``last`` is true
    for a null key), ``first`` holds the same four of the first line, null for
    a line that is alone.
    """
    ship_package(docs.sparkSession)
    rows = cut_lineage(line_places(docs, key, column), "lines")
    exact = rows.groupBy("line").agg(F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("n"))
    exact = cut_lineage(exact, "exact")
    roots = cut_lineage(components(close_lines(docs, column, most, least)), "roots").withColumnRenamed("node", "line")
    linked = cut_lineage(exact.join(roots, "line").select("line", "root", "first"), "linked")
    least_of = linked.groupBy("root").agg(F.min("first").alias("first"))
    near = linked.select("line", "root").join(least_of, "root").select("line", F.col("first").alias("near"))
    copies = exact.filter("n > 1").select("line", "first")
    several = copies.join(near, "line", "full").select("line", F.coalesce("near", "first").alias("first"))
    return rows.join(cut_lineage(several, "several"), "line", "left").select(*PLACE, "first")


def removable() -> Column:
    """True for a line of ``line_classes`` that is not the first of its class."""
    return F.col("first").isNotNull() & (F.struct(*PLACE) != F.col("first"))


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", column: str = "text", most: int = MOST, least: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with only the first line of every class left in ``column``; all other columns as they are."""
    gone = line_classes(docs, key, column, most, least).filter(removable())
    marks, digest, number = (free_name(docs.columns, c) for c in ("gone", "text_hash", "key"))
    gone = gone.groupBy(F.col("key").alias(number), F.col("text_hash").alias(digest)).agg(F.collect_set("line_no").alias(marks))
    keyed = docs.withColumn(digest, F.xxhash64(column)).withColumn(number, F.col(key))
    joined = null_safe_join(keyed, cut_lineage(gone, "gone"), [number, digest], "left").drop(number, digest)
    return _without_lines(joined, column, marks).select(*docs.columns)


def _without_lines(df: DataFrame, column: str, marks: str) -> DataFrame:
    ship_package(df.sparkSession)
    schema = StructType([f for f in df.schema.fields if f.name != marks])
    arrow = to_arrow_schema(schema)
    place = [f.name for f in schema].index(next(f.name for f in schema if f.name.lower() == column.lower()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = values(batch, schema[place].name), values(batch, marks)
            kept = [
                t if not g or t is None else "\n".join(s for skip in (set(g),) for i, s in enumerate(t.split("\n")) if i not in skip)
                for t, g in zip(texts, gone, strict=True)
            ]
            arrays = [batch.column(f.name) for f in arrow]
            arrays[place] = pa.array(kept, arrow.field(place).type)
            yield pa.RecordBatch.from_arrays([pc.cast(a, f.type) for a, f in zip(arrays, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)
