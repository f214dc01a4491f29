"""Byte-pair encoding and decoding with the vocabulary file of a public tokenizer.

The distinct words of a batch lie end to end in one flat array of symbols. A
round looks up all neighbouring pairs by binary search over the sorted pair
keys of the vocabulary, takes the pair of lowest rank in every word and merges
its occurrences from the left. Words in which no pair is left drop out, so a
round costs what is still open. Only pairs beside a merge are looked up again.

Nulls are empty texts; an empty text has no tokens and decodes to the empty
text. Special tokens in a text get their own ids, as in the library that the
files are made for. Letters newer than the Unicode tables of Python's libraries may be
split otherwise than there. Rows are independent: ties, repeated rows and empty tables
need no rule.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagemill.llm.batches import CHUNK_BYTES, chunks, extended, pieces, values
from pagemill.session import ship_package

NO_RANK = np.iinfo(np.int32).max
CACHED_UNITS = 200_000
DECODED = 1 << 16  # ids at a time
NOT_BLANK = "\x1c\x1d\x1e\x1f"  # white space for str.split, not for the pattern
# Fixed value: how the files of byte-level vocabularies without a pattern of their own split a text.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def lower_each(text: str) -> str:
    """Lower case letter by letter: a final sigma is no special case."""
    return text.replace("Σ", "σ").lower()


class Vocabulary:
    """A byte-level BPE vocabulary, parsed from the JSON of its file."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        ids, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.steps = [s for s in _parts(spec["normalizer"], "normalizers") if s["type"] != "Replace"]
        pieces = _parts(spec["pre_tokenizer"], "pretokenizers")
        own = [p["pattern"]["Regex"] for p in pieces if p["type"] == "Split"]
        self.pattern = regex.compile(own[0] if own else BYTE_LEVEL_PATTERN)
        self.unit_pattern = regex.compile(f"(?:{self.pattern.pattern})|\n")
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.specials)) or r"(?!)")
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.last = np.array([ids[c + suffix] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([(ids[a] << 32) | ids[b] for a, b in pairs], np.int64)
        merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        first = np.unique(keys, return_index=True)[1]
        self.keys, self.ranks, self.merged = keys[first], first.astype(np.int32), merged
        decoder = (spec.get("decoder") or {}).get("type")
        words = {i: w for w, i in ids.items()} | {i: w for w, i in self.specials.items()}
        self.joiner, values_of = b" ", {i: w.encode() for i, w in words.items()}
        if decoder == "ByteLevel":
            of_letter = {c: b for b, c in enumerate(letters)}
            self.joiner = b""
            values_of = {i: bytes(of_letter[c] for c in w) if i not in self.specials.values() else w.encode() for i, w in words.items()}
        elif decoder is not None:
            raise ValueError(f"decoder {decoder} is not supported")
        self.texts = [values_of.get(i, b"") for i in range(max(values_of) + 1)]
        self.by_blanks = not any(" " in w for w in self.pattern.findall(" a b "))
        self.cache: dict[str, bytes] = {}

    def normal(self, text: str) -> str:
        for step in self.steps:
            if step["type"] == "NFC":
                text = text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)
            elif step["type"] == "Lowercase":
                text = lower_each(text)
            else:
                raise ValueError(f"normalizer {step['type']} is not supported")
        return text

    def words(self, text: str) -> list[str]:
        """The words of a text; a special token is a word by itself."""
        if not any(s in text for s in self.specials):
            return self.pattern.findall(self.normal(text))
        found, end = [], 0
        for match in self.special_pattern.finditer(text):
            found += [*self.pattern.findall(self.normal(text[end : match.start()])), match[0]]
            end = match.end()
        return found + self.pattern.findall(self.normal(text[end:]))

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of every pair in the merge list, ``NO_RANK`` where it has none."""
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of every word, little-endian 32-bit, by rounds of merges over all words at once."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.inner[np.frombuffer(b"".join(raw), np.uint8)]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[np.frombuffer(b"".join(w[-1:] for w in raw), np.uint8)]
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        rank = np.full(len(symbols), NO_RANK, np.int32)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self.rank_of(symbols[inside], symbols[inside + 1])
        done_words, done_symbols = [], []
        while len(symbols):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            lowest = np.minimum.reduceat(rank, starts)
            spread = np.repeat(lowest, np.diff(starts, append=len(word)))
            if (lowest == NO_RANK).any():
                closed = spread == NO_RANK
                done_words.append(word[closed])
                done_symbols.append(symbols[closed].astype("<u4"))
                symbols, word, rank, spread = (x[~closed] for x in (symbols, word, rank, spread))
                if not len(symbols):
                    break
            # Of overlapping pairs (a run of one symbol) every second one is merged, from the left.
            at = np.flatnonzero(rank == spread)
            run = np.diff(at, prepend=-2) > 1
            if not run.all():
                begin = at[run][np.cumsum(run) - 1]
                at = at[(at - begin) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            rank[at] = rank[at + 1]
            again = np.zeros(len(symbols), bool)
            again[at] = True
            symbols, word, rank, again = symbols[keep], word[keep], rank[keep], again[keep]
            again[:-1] |= again[1:]
            again[:-1] &= word[1:] == word[:-1]
            again[-1] = False
            beside = np.flatnonzero(again)
            rank[beside] = self.rank_of(symbols[beside], symbols[beside + 1])
        order = np.concatenate(done_words)
        place = np.argsort(order, kind="stable")
        flat = np.concatenate(done_symbols)[place].tobytes()
        stops = np.cumsum(np.bincount(order, minlength=len(words)) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *stops], stops)]

    def units(self, text: str) -> list[str]:
        """Parts of a text that are encoded by themselves.

        Where the pattern matches no white space, these are the parts between
        white space, whose ids are found again by dictionary; else the words.
        """
        if not self.by_blanks or any(c in text for c in NOT_BLANK):
            return self.words(text)
        return text.split()

    def words_of(self, units: list[str]) -> list[list[str]]:
        """The words of every unit; all are split together, with line ends between them."""
        joined = "\n".join(units)
        if any(s in joined for s in self.specials):
            return [self.words(u) for u in units]
        split: list[list[str]] = [[]] if units else []
        for word in self.unit_pattern.findall(self.normal(joined)):
            if word == "\n":
                split.append([])
            else:
                split[-1].append(word)
        return split

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text as little-endian unsigned 32-bit integers.

        Where white space parts the words, a long text is encoded in pieces.
        """
        if not any(map(self.is_long, texts)):
            return self.encode_some(texts)
        return [b"".join(self.encode_some([p])[0] for p in (pieces(t) if self.is_long(t) else [t])) for t in texts]

    def is_long(self, text: str | None) -> bool:
        """Should and can the text be cut at white space?"""
        if text is None or len(text) <= CHUNK_BYTES or not self.by_blanks or any(c in text for c in NOT_BLANK):
            return False
        return not any(c.isspace() for s in self.specials for c in s)

    def encode_some(self, texts: list[str | None]) -> list[bytes]:
        split = [self.units(t) if t else [] for t in texts]
        if len(self.cache) > CACHED_UNITS:
            self.cache.clear()
        new = list({u for us in split for u in us}.difference(self.cache))
        words = self.words_of(new) if self.by_blanks else [[u] for u in new]
        ids = {w: np.array([i], "<u4").tobytes() for w, i in self.specials.items()}
        distinct = list({w for ws in words for w in ws}.difference(ids))
        ids |= zip(distinct, self.encode_words(distinct), strict=True)
        for unit, ws in zip(new, words, strict=True):
            self.cache[unit] = b"".join([ids[w] for w in ws])
        return [b"".join(map(self.cache.__getitem__, us)) for us in split]

    def decode(self, ids: bytes | None) -> str:
        numbers = np.frombuffer(ids or b"", "<u4")
        parts = (map(self.texts.__getitem__, numbers[i : i + DECODED].tolist()) for i in range(0, len(numbers), DECODED))
        return self.joiner.join(map(self.joiner.join, parts)).decode("utf-8", "replace")


def _parts(step: dict | None, name: str) -> list[dict]:
    if not step:
        return []
    return [p for s in step[name] for p in _parts(s, name)] if step["type"] == "Sequence" else [step]


@lru_cache(maxsize=2)
def vocabulary(source: str) -> Vocabulary:
    return Vocabulary(source)


def _apply(df: DataFrame, path: str, column: str, added: list[T.StructField], work) -> DataFrame:
    """Run ``work(vocabulary, values of column)`` on every chunk; it gives a list for each added column."""
    ship_package(df.sparkSession)
    source = df.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))
    names = {f.name.lower() for f in added}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    schema = T.StructType(kept + added)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(source.value)
        for batch in batches:
            for part in chunks(batch, column):
                columns = work(words, values(part, column))
                new = {f.name: pa.array(c, arrow.field(f.name).type) for f, c in zip(added, columns, strict=True)}
                yield extended(part, arrow, new)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, column: str = "text", name: str = "token_ids") -> DataFrame:
    """Add the token ids of ``column`` as binary: little-endian unsigned 32-bit integers.

    ``path`` is the vocabulary file; the driver reads it and sends it to the
    tasks, a few megabytes that do not grow with the data. An existing column
    ``name`` is replaced.
    """
    return _apply(df, path, column, [T.StructField(name, T.BinaryType())], lambda v, texts: [v.encode(texts)])


def decode(df: DataFrame, path: str, column: str = "token_ids", name: str = "decoded") -> DataFrame:
    """Add the text of the token ids in ``column``, special tokens included."""
    return _apply(df, path, column, [T.StructField(name, T.StringType())], lambda v, ids: [[v.decode(i) for i in ids]])


def encode_decode(df: DataFrame, path: str, column: str = "text", ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """Both in one pass over the texts."""

    def work(words: Vocabulary, texts: list[str | None]) -> list[list]:
        encoded = words.encode(texts)
        return [encoded, [words.decode(e) for e in encoded]]

    return _apply(df, path, column, [T.StructField(ids, T.BinaryType()), T.StructField(decoded, T.StringType())], work)
