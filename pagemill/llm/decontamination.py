"""Benchmark decontamination by templates.

Words are lower-cased; numbers, names and units become typed placeholders, so a
question whose numbers or names were changed has the same template. Windows of
``WORDS`` template words are hashed and joined with those of the benchmark. An
item leaks into a document if at least ``SHARE`` of its windows are found near
one place, and if the slots agree: what stood in the item's placeholders was
replaced by the same thing wherever it occurs. Windows are hashed with and
without placeholders for names, since text in capitals shows none.

A name is a capitalised word that doesn't begin a sentence; a unit is a word of
``UNITS`` after a number. Marks between words don't count. An item of fewer than
``WORDS`` words is one window and leaks if its words stand somewhere as they
are, without placeholders. Items and texts without words, null and empty ones
among them, have no windows. Two documents with the same key and text give one
row; items with the same id and text count once; an empty table on either side
gives no rows. A place is a stretch of the document about as long as the item,
in two overlapping divisions. A long text is read in pieces of ``PIECE`` letters
that overlap by a window, so it needs no more memory than its own size.

A template window that an item repeats also meets the other places of its
copies there. So slots are judged along one alignment at a time: every window
takes the match nearest to a common offset, if that keeps the order of the
windows; those must agree. Windows left over count if one of their matches
agrees as well. Every offset at a place is tried.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from pagemill.llm.batches import chunks, free_name, values
from pagemill.llm.bits import BITS, bit_filter, may_hold
from pagemill.operators.ordering import null_safe_join
from pagemill.session import ship_package
from pagemill.storage import cut_lineage

WORDS = 5
SHARE = 0.8
PIECE = 1 << 19  # letters of a text that are looked at together
NAME, NUMBER, UNIT = 1 << 3, 2 << 3, 3 << 3
BASE, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd multipliers
CODE = 0xFFFFFFFFFFFFFFF8
# Units that may follow a number.
UNITS = frozenset(
    "mm cm m km meter meters metre metres kilometer kilometers kilometre kilometres inch inches foot feet yard yards mile miles "
    "mg g kg gram grams kilogram kilograms ton tons tonne tonnes ounce ounces pound pounds lb lbs ml l liter liters litre litres "
    "gallon gallons second seconds minute minutes hour hours day days week weeks month months year years percent degree degrees "
    "cent cents dollar dollars euro euros".split()
)
BLANK = re.compile(r"\s")
ENDINGS, QUOTES = (np.array([ord(c) for c in marks], np.uint32) for marks in (".!?:…", "\"'”’)"))
PLAIN, CAPITAL, DIGITS, MEASURE, ENDS = 0, 1, 2, 3, 4  # the low three bits of a word's code

DOC_WINDOWS = StructType(
    [StructField("row", LongType()), StructField("at", IntegerType()), StructField("hash", LongType()), StructField("slots", ArrayType(StringType()))]
)


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """What every letter of the basic plane is, and its lower case."""
    kinds, lower = np.zeros(1 << 16, np.uint8), np.arange(1 << 16, dtype=np.uint32)
    for point in range(1 << 16):
        letter = chr(point)
        if letter.isspace():
            kinds[point] = SPACE
        elif letter.isdecimal():
            kinds[point] = DIGIT
        elif letter.isalnum():
            kinds[point] = LETTER | (UPPER if letter.isupper() or letter.istitle() else SMALL if letter.islower() else 0)
            lower[point] = ord(letter.lower()[0])
    kinds[[ord(c) for c in "'’"]], kinds[[ord(c) for c in ".,"]] = APOSTROPHE, POINT
    return kinds, lower


SPACE, DIGIT, LETTER, APOSTROPHE, POINT, UPPER, SMALL = 1, 2, 4, 8, 16, 32, 64
KINDS, LOWER = _letters()


@lru_cache(maxsize=2)
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier of the letters' sums, and of its inverse."""
    up = np.full(count, BASE, np.uint64)
    down = np.full(count, pow(BASE, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@dataclass
class Words:
    """The words of a text: a code each, where they start and end; a code is a hash, a kind and whether a sentence ends."""

    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def words_of(text: str) -> Words:
    """All words at once, by columns over the letters.

    A word is a run of letters, with apostrophes between letters, or a run of
    digits, with points and commas between digits. Letters beyond the basic
    plane are letters without a case.
    """
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    count = len(points)
    small = np.minimum(points, 0xFFFF)
    kind = np.where(points > 0xFFFF, np.uint8(LETTER), KINDS[small])
    lower = np.where(points > 0xFFFF, points, LOWER[small])
    joined = np.flatnonzero(kind & (APOSTROPHE | POINT))
    joined = joined[(joined > 0) & (joined < count - 1)]
    wanted = np.where(kind[joined] == APOSTROPHE, LETTER, DIGIT)
    inside = joined[(kind[joined - 1] & kind[joined + 1] & wanted) > 0]
    part = kind & (LETTER | DIGIT)
    part[inside] = np.where(kind[inside] == APOSTROPHE, LETTER, DIGIT)
    change = np.diff(part, prepend=0, append=0) != 0
    edges = np.flatnonzero(change)
    starts = edges[:-1][part[edges[:-1]] > 0] if len(edges) else edges
    ends = edges[1:][part[edges[:-1]] > 0] if len(edges) else edges
    up, down = _powers(1 << max(10, (count - 1).bit_length()))
    sums = np.zeros(count + 1, np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * up[:count], out=sums[1:])
    codes = (sums[ends] - sums[starts]) * down[starts]
    codes ^= codes >> np.uint64(31)
    codes = (codes * np.uint64(MIX)) ^ ((codes * np.uint64(MIX)) >> np.uint64(29))
    codes &= np.uint64(0xFFFFFFFFFFFFFFF8)
    capitals, smalls = (np.r_[0, np.cumsum((kind & case) > 0)] for case in (UPPER, SMALL))
    titled = ((kind[starts] & UPPER) > 0) & (capitals[ends] - capitals[starts] == 1) & (smalls[ends] > smalls[starts])
    codes |= np.where(part[starts] == DIGIT, np.uint64(DIGITS), np.where(titled, np.uint64(CAPITAL), np.uint64(PLAIN)))
    # The last word between two blanks ends a sentence if a mark for that is the last letter but quotes.
    blank = kind == SPACE
    last = np.maximum.accumulate(np.where(np.isin(points, QUOTES), -1, np.arange(count)))
    stops = np.flatnonzero(np.diff(blank.astype(np.int8), append=1) == 1)  # the last letter of every part
    begins = np.flatnonzero(np.diff(blank.astype(np.int8), prepend=1) == -1)
    closing = last[stops]
    ended = (closing >= begins) & np.isin(points[closing], ENDINGS)
    at = np.searchsorted(starts, stops[ended], side="right") - 1
    at = at[(at >= 0) & (starts[at] >= begins[ended])] if len(starts) else at[:0]
    codes[at] |= np.uint64(ENDS)
    return Words(codes, starts, ends)


UNIT_CODES = words_of(" ".join(sorted(UNITS))).codes & np.uint64(CODE)


def templates(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template words with and without placeholders for names, and which words are slots; ``first`` marks first words."""
    base, kind = codes & np.uint64(CODE), codes & np.uint64(3)
    before = np.r_[np.uint64(ENDS), codes[:-1]] if len(codes) else codes
    begins = first | ((before & np.uint64(ENDS)) > 0)
    number = kind == DIGITS
    unit = (kind == MEASURE) & ~first & ((before & np.uint64(3)) == DIGITS)
    name = (kind == CAPITAL) & ~begins
    plain = np.where(number, np.uint64(NUMBER), np.where(unit, np.uint64(UNIT), base))
    return np.where(name, np.uint64(NAME), plain), plain, number | unit | name


def window_hashes(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    count = max(0, len(words) - size + 1)
    total = np.full(count, WORDS - size, np.uint64)
    for j in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[j : j + count]
        total ^= total >> np.uint64(29)
    return total.view(np.int64)


@dataclass
class Segment:
    """Part of a text, the number of its first word, and how many of its words the segment before has had as well."""

    text: int
    letters: str
    at: int = 0
    again: int = 0


def segment_groups(texts: list[str | None], size: int = PIECE) -> Iterator[list[Segment]]:
    """The texts cut at white space into segments of about ``size`` letters, together of about as many.

    A segment begins with the last words of the one before, so every window lies whole in one.
    """
    group, held = [], 0
    for i, text in enumerate(texts):
        at, before, text = 0, Segment(i, ""), text or ""
        while at < len(text):
            cut = BLANK.search(text, at + size) if at + size < len(text) else None
            end = cut.start() if cut else len(text)
            segment = Segment(i, before.letters + text[at:end], before.at, before.again)
            group.append(segment)
            held += len(segment.letters)
            if held >= size:
                yield group
                group, held = [], 0
            at = end
            if cut:
                before = _tail(segment)
    if group:
        yield group


def _tail(segment: Segment) -> Segment:
    """The end of a segment as the start of the next: from the blank before the word before the next new window."""
    words = words_of(segment.letters)
    first = max(0, len(words.starts) - WORDS)
    start = int(words.starts[first]) if len(words.starts) else len(segment.letters)
    while start and not segment.letters[start - 1].isspace():
        start -= 1
    first = int(np.searchsorted(words.starts, start))
    return Segment(segment.text, segment.letters[start:], segment.at + first, len(words.starts) - first)


def group_windows(group: list[Segment], wanted: np.ndarray | None, short: Sequence[int]) -> tuple[list, ...]:
    """Text number, place, hash and slot values of the windows of some segments; with ``wanted`` only hashes it may hold."""
    joined = " ".join(s.letters for s in group)
    words = words_of(joined)
    codes = words.codes
    begins = np.cumsum([0, *[len(s.letters) + 1 for s in group[:-1]]])
    owner = np.searchsorted(begins, words.starts, side="right") - 1
    starts = np.searchsorted(words.starts, begins)
    first = np.zeros(len(codes) + 1, bool)
    first[starts[np.array([s.at == 0 for s in group])]] = True
    first = first[:-1]
    known = starts[owner] + np.array([s.again for s in group], np.int64)[owner] - np.arange(len(codes))  # words left that the segment before had
    measures = np.isin(codes & np.uint64(CODE), UNIT_CODES)
    codes = np.where(measures, (codes & np.uint64(CODE | ENDS)) | np.uint64(MEASURE), codes)
    named, plain, slot = templates(codes, first)
    base = codes & np.uint64(CODE)
    found: list[tuple[np.ndarray, np.ndarray, int, int]] = []
    whole = window_hashes(named)
    for form, size, hashes in [(0, WORDS, whole), (1, WORDS, window_hashes(plain)), *((2, n, window_hashes(base, n)) for n in short)]:
        keep = (known[: len(hashes)] < size) & (owner[: len(hashes)] == owner[size - 1 :]) if len(hashes) else np.zeros(0, bool)
        if form == 1:
            keep &= whole != hashes
        if wanted is not None:
            keep &= may_hold(wanted, hashes)
        at = np.flatnonzero(keep)
        found.append((at, hashes[at], form, size))
    capital = (codes & np.uint64(3)) == CAPITAL
    slots: list[list[str]] = []
    for at, _, form, size in found:
        for i in at.tolist():
            places = [j for j in range(i, i + size) if slot[j] and (form == 0 or not capital[j])] if form < 2 else []
            slots.append([joined[words.starts[j] : words.ends[j]].lower() for j in places])
    at, hashes = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    of = owner[at]
    place = at - starts[of] + np.array([s.at for s in group], np.int64)[of]
    return np.array([s.text for s in group], np.int64)[of].tolist(), place.tolist(), hashes.tolist(), slots


def window_rows(df: DataFrame, keys: list[str], column: str, wanted: np.ndarray | None, short: Sequence[int] = ()) -> DataFrame:
    """``keys, at, hash, slots`` of the windows in ``column``; texts of fewer words than ``WORDS`` have one if ``short`` has their number."""
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(wanted)
    schema = StructType([*[df.schema[k] for k in keys], *DOC_WINDOWS.fields[1:]])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, column):
                for group in segment_groups(values(part, column)):
                    row, *rest = group_windows(group, shared.value, short)
                    if row:
                        taken = [part.column(k).take(pa.array(row, pa.int64())).cast(arrow.field(k).type) for k in keys]
                        new = [pa.array(c, f.type) for c, f in zip(rest, list(arrow)[len(keys) :], strict=True)]
                        yield pa.RecordBatch.from_arrays([*taken, *new], schema=arrow)

    return df.select(*keys, column).mapInArrow(run, schema)


def item_windows(items: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The windows of benchmark items; an item of fewer than ``WORDS`` words is one window, of its words as they are."""
    ship_package(items.sparkSession)
    schema = StructType([*[items.schema[k] for k in keys], *DOC_WINDOWS.fields[1:], StructField("words", IntegerType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, column):
                found: list[tuple] = []
                for i, text in enumerate(values(part, column)):
                    size = len(words_of(text or "").codes)
                    for group in segment_groups([text]):
                        windows = zip(*group_windows(group, None, [size] if 0 < size < WORDS else []), strict=True)
                        found += [(i, *w[1:], min(size, WORDS)) for w in windows]
                if found:
                    row, *rest = zip(*found, strict=True)
                    taken = [part.column(k).take(pa.array(row, pa.int64())).cast(arrow.field(k).type) for k in keys]
                    new = [pa.array(c, f.type) for c, f in zip(rest, list(arrow)[len(keys) :], strict=True)]
                    yield pa.RecordBatch.from_arrays([*taken, *new], schema=arrow)

    return items.select(*keys, column).mapInArrow(run, schema)


def _agrees(now: dict[str, str], pairs: list[tuple[str, str]]) -> bool:
    """Adds ``pairs`` to ``now``, unless one of them contradicts it or another one."""
    new: dict[str, str] = {}
    if any(now.get(was, new.setdefault(was, value)) != value or new[was] != value for was, value in pairs):
        return False
    now.update(new)
    return True


def _nearest(offsets: list[int], base: int) -> int:
    """The offset next to ``base``, the lesser of two."""
    i = bisect(offsets, base)
    return min(offsets[max(0, i - 1) : i + 1], key=lambda o: (abs(o - base), o))


def aligned(matches: list[tuple[int, int, list[tuple[str, str]]]], least: float) -> tuple[int, bool] | None:
    """The windows found along the best alignment of a place, and whether one is verbatim; none if fewer than ``least`` agree.

    A match is the number of the item's window, its offset in the document and
    the pairs of slots, what was there and is there now.
    """
    found: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
    for window, offset, pairs in matches:
        found[window][offset] += pairs
    most, verbatim = 0, False
    rising = {w: sorted(offsets) for w, offsets in found.items()}
    for base, _ in Counter(o for offsets in found.values() for o in offsets).most_common():
        near = {w: _nearest(offsets, base) for w, offsets in rising.items()}
        line: list[tuple[int, int]] = []  # windows and their places, both rising
        rest = []
        for w in sorted(near, key=lambda w: (abs(near[w] - base), w)):
            entry = (w, w + near[w])
            i = bisect(line, entry)
            if (i and line[i - 1][1] >= entry[1]) or (i < len(line) and line[i][1] <= entry[1]):
                rest.append(w)
            else:
                line.insert(i, entry)
        now: dict[str, str] = {}
        if not all(_agrees(now, found[w][place - w]) for w, place in line):
            continue
        same = len(line) >= least and all(was == value for was, value in now.items())
        count = len(line) + sum(any(_agrees(now, found[w][o]) for o in sorted(rising[w], key=lambda o: (abs(o - base), o))) for w in rest)
        if count >= least:
            most, verbatim = max(most, count), verbatim or same or all(was == value for was, value in now.items())
        if verbatim and most == len(found):
            break
    return (most, verbatim) if most else None


def judged(places: DataFrame, share: float) -> DataFrame:
    """``matched`` and ``verbatim`` of the places whose windows agree along an alignment, instead of ``matches``."""
    schema = StructType([f for f in places.schema.fields if f.name != "matches"] + [StructField("matched", LongType()), StructField("verbatim", BooleanType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, matched, verbatim = [], [], []
            for i, (of, matches) in enumerate(zip(values(batch, "windows"), batch.column("matches"), strict=True)):
                listed = [(m["item_at"], m["offset"], list(zip(m["was"], m["now"], strict=True))) for m in matches.as_py()]
                if best := aligned(listed, share * of):
                    row.append(i)
                    matched.append(best[0])
                    verbatim.append(best[1])
            if row:
                taken = [batch.column(f.name).take(pa.array(row)).cast(f.type) for f in list(arrow)[:-2]]
                yield pa.RecordBatch.from_arrays([*taken, pa.array(matched, pa.int64()), pa.array(verbatim)], schema=arrow)

    return places.mapInArrow(run, schema)


def leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", column: str = "text", item: str = "item_id", item_text: str = "text", share: float = SHARE, bits: int = BITS
) -> DataFrame:
    """``key, text_hash, item_id, matched, windows, share, verbatim`` for every item found in a document.

    ``text_hash`` is Spark's hash of the text; ``matched`` of the item's
    ``windows`` were found; ``verbatim`` is false for a re-parameterised one.
    """
    items = benchmark.select(F.col(item).alias("item_id"), F.col(item_text).alias("_text")).distinct()
    items = items.withColumn("item_hash", F.xxhash64("_text"))
    known = cut_lineage(item_windows(items, ["item_id", "item_hash"], "_text"), "items")
    short = sorted(r["words"] for r in known.filter(F.col("words") < WORDS).select("words").distinct().collect())
    known = known.drop("words").withColumnsRenamed({"at": "item_at", "slots": "item_slots"})
    sizes = known.groupBy("item_id", "item_hash").agg(F.countDistinct("item_at").alias("windows"))
    # The tasks drop most windows that no item has.
    wanted = bit_filter(known, "hash", bits)
    texts = docs.select(F.col(key).alias("key"), F.xxhash64(column).alias("text_hash"), F.col(column).alias("_text"))
    found = cut_lineage(window_rows(texts, ["key", "text_hash"], "_text", wanted, short), "windows").distinct()
    met = found.join(null_safe_join(known, sizes, ["item_id", "item_hash"]), "hash").filter(F.size("slots") == F.size("item_slots"))
    span = F.greatest("windows", F.lit(8))
    offset = F.col("at") - F.col("item_at")
    cells = F.array(F.struct(F.lit(0), F.floor(offset / span)), F.struct(F.lit(1), F.floor((offset + span / 2) / span)))
    match = F.struct("item_at", offset.alias("offset"), F.col("item_slots").alias("was"), F.col("slots").alias("now"))
    owner = ["key", "text_hash", "item_id", "item_hash", "windows"]
    placed = met.select(*owner, match.alias("match"), F.explode(cells).alias("cell"))
    near = placed.groupBy(*owner, "cell").agg(F.collect_list("match").alias("matches"))
    enough = F.size(F.array_distinct(F.col("matches.item_at"))) >= share * F.col("windows")
    good = judged(near.filter(enough).drop("cell"), share)
    best = good.groupBy(*owner).agg(F.max("matched").alias("matched"), F.max("verbatim").alias("verbatim"))
    part = F.col("matched") / F.col("windows")
    return best.select(F.col("key").alias(key), "text_hash", "item_id", "matched", "windows", part.alias("share"), "verbatim")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", column: str = "text", share: float = SHARE) -> DataFrame:
    """The documents into which no item leaks, with all their columns."""
    mark, number = (free_name(docs.columns, c) for c in ("text_hash", "key"))
    found = leaks(docs, benchmark, key, column, share=share).select(F.col(key).alias(number), F.col("text_hash").alias(mark)).distinct()
    marked = docs.withColumn(mark, F.xxhash64(column)).withColumn(number, F.col(key))
    return null_safe_join(marked, cut_lineage(found, "leaks"), [number, mark], "left_anti").select(*docs.columns)
