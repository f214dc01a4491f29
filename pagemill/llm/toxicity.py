"""Toxicity by a support vector machine on a subsequence string kernel.

Two words are alike by the subsequences of three letters that they share, where
a subsequence that is spread over more letters counts less: ``DECAY`` to the
power of its span, up to ``SPAN``. Inserted letters and gaps then take away
only part of the likeness. The kernel is normalised by each word's kernel with
itself, so that neither long nor monotonous words win.

The machine is trained in the space of Nyström landmarks, words of toxic and of
clean sentences. A labelled sentence is a bag of words: all words of a clean
one are clean; of a toxic one the toxic word is one that speaks most for
toxicity, and so are copies of it with a letter put in. The machine is trained
in rounds: each adds the clean words that the last one took for toxic, until
there are none or ``ROUNDS`` are over. Accents, digits and the start of a word
are letters of their own; other scripts share ``LETTERS - OTHERS`` codes. Since
the kernel is a sum over subsequences, the landmarks' weights collapse into one
table of ``LETTERS`` cubed numbers, and a word's score is a sum of look-ups. A text scores by its four most toxic words and its length,
passed through a logistic curve that is fitted on texts the machine has not
seen: the two halves of the sample judge each other.

White space parts words; a run of single letters (``i d i o t``) is one word,
and marks inside a word are skipped. Null and empty texts have no word and
score as the bias alone, which is clean. Repeated rows score alike; an empty
table gives an empty result; an existing column of the score's name is replaced.
A long text is read in pieces. Without labels of both kinds every text scores 0.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import nlargest
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagemill.llm.batches import CHUNK_BYTES, chunks, extended, pieces, values
from pagemill.llm.labelled import Sample, fit_sigmoid, sample_labelled, sigmoid
from pagemill.session import ship_package

BITS = 6
LETTERS = 1 << BITS  # 0 is no letter, 1 to 26 are a to z, then come the start of a word, accents, digits and all others
START, ACCENTS, DIGITS, OTHERS = 27, 28, 32, 42
SPAN = 6
DECAY = 0.65
GAPS = [(a, b) for a, b in combinations(range(1, SPAN), 2)]
LANDMARKS = 400
PER_CLASS, MAX_CHARS = 1_600, 20_000  # bounds of the labelled sample
LONGEST = 32  # letters; longer words are cut to overlapping pieces
NEAR_ODDS = 0.7
PART = 5
ROUNDS = 9
PARTS = 3  # of the clean words, one is read in each round
MARGIN = -0.5  # a clean word that scores more is learnt from in the next round
PARAGRAPH = 64  # words
CACHED_WORDS = 200_000
NO_WORD = -1e9

APART = re.compile(r"(?<=\w\w)\s+(?=\w\w)")  # a cut here parts no run of single letters
SPACED = re.compile(r" [^\W\d_](?: [^\W\d_](?= )){2,}")
MARKS = regex.compile(r"[\p{M}\0]")


def words_of(text: str | None) -> list[str]:
    """Lower-case words; runs of single letters are put together, long words are cut."""
    if not text:
        return []
    words = text.lower().split()
    spaced = [m.replace(" ", "") for m in SPACED.findall(f" {' '.join(words)} ")]
    if max(map(len, words), default=0) > LONGEST:
        step = LONGEST // 2
        words = [w[i : i + LONGEST] for w in words for i in range(0, max(1, len(w) - step), step)]
    return words + spaced


def codes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words, each after a sign of its start and followed by ``SPAN`` zeros, and where each word starts.

    An accent is a letter of its own after the one that it stands on, so a word
    without it is the word with a letter left out.
    """
    plain = unicodedata.normalize("NFKD", "".join(f"\r{w.translate(_NO_ENDS)}\n" for w in words))
    points = np.frombuffer(plain.encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(points < 128, _ASCII[np.minimum(points, 127)], OTHERS + points % (LETTERS - OTHERS))
    if not plain.isascii():
        accents = np.frombuffer(MARKS.sub("\0", plain).encode("utf-32-le", "replace"), np.uint32) == 0
        codes = np.where(accents, ACCENTS + points % (DIGITS - ACCENTS), codes)
    ends = points == 10
    kept = ends | (codes > 0)
    codes, ends = codes[kept], ends[kept]
    # Of a letter three times in a row and more two are left.
    again = np.r_[False, codes[1:] == codes[:-1]] & ~ends
    kept = ~(again & np.r_[False, again[:-1]])
    codes, ends = codes[kept], ends[kept]
    flat = np.repeat(codes, np.where(ends, SPAN, 1))
    stops = np.cumsum(np.where(ends, SPAN, 1))[ends]
    return flat.astype(np.int32), np.r_[0, stops[:-1]]


_NO_ENDS = {10: None, 13: None}
_ASCII = np.zeros(128, np.int64)
_ASCII[ord("a") : ord("z") + 1] = np.arange(1, 27)
_ASCII[ord("0") : ord("9") + 1] = np.arange(DIGITS, OTHERS)
_ASCII[13] = START


def subsequences(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each way to leave gaps: number of the subsequence at every place, whether there is one, its weight."""
    padded = np.r_[codes, np.zeros(SPAN, np.int32)]
    n = len(codes)
    for a, b in GAPS:
        second, third = padded[a : a + n], padded[b : b + n]
        yield (codes << 2 * BITS) | (second << BITS) | third, (codes > 0) & (second > 0) & (third > 0), DECAY ** (b + 1)


@dataclass(frozen=True)
class Features:
    """Every subsequence of every word once: its word, its number and its summed weight, and the norm of each word."""

    word: np.ndarray
    number: np.ndarray
    weight: np.ndarray
    norm: np.ndarray


def features(words: list[str]) -> Features:
    codes, starts = codes_of(words)
    word = np.zeros(len(codes), np.int64)
    word[starts[1:]] = 1
    word = np.cumsum(word) << 3 * BITS
    keys, weights = [], []
    for number, there, weight in subsequences(codes):
        at = np.flatnonzero(there)
        keys.append(word[at] | number[at])
        weights.append(np.full(len(at), weight, np.float32))
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key)
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    key = key[first]
    weight = np.add.reduceat(weight, first) if len(first) else weight
    owner = key >> 3 * BITS
    norm = np.sqrt(np.bincount(owner, weight.astype(float) ** 2, len(words)))
    return Features(owner, key & (LETTERS**3 - 1), weight, np.maximum(norm, 1e-6))


def kernel_rows(words: list[str], columns: np.ndarray) -> np.ndarray:
    """Normalised features of words, over the subsequences numbered in ``columns`` (-1: not used)."""
    found = features(words)
    rows = np.zeros((len(words), int(columns.max()) + 1), np.float32)
    kept = columns[found.number] >= 0
    rows[found.word[kept], columns[found.number[kept]]] = found.weight[kept]
    rows /= found.norm[:, None].astype(np.float32)
    return rows


def embedded(words: list[str], columns: np.ndarray, to_points: np.ndarray, at_once: int = 200) -> np.ndarray:
    """The words' places in the space of the landmarks."""
    points = np.zeros((len(words), to_points.shape[1]))
    for start in range(0, len(words), at_once):
        found = features(words[start : start + at_once])
        at = np.flatnonzero(columns[found.number] >= 0)
        if len(at):
            first = np.flatnonzero(np.diff(found.word[at], prepend=-1))
            owner = found.word[at][first]
            sums = np.add.reduceat(to_points[columns[found.number[at]]] * found.weight[at, None], first)
            points[start + owner] = sums / found.norm[owner, None]
    return points


@dataclass(frozen=True)
class Toxicity:
    """The collapsed machine: a weight for every subsequence, the bias, and the calibration."""

    weights: np.ndarray
    bias: float
    slopes: np.ndarray
    shift: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        found = features(words)
        total = np.bincount(found.word, self.weights[found.number] * found.weight, len(words))
        return total / found.norm + self.bias

    def all_scores(self, words: list[str], at_once: int = 4_000) -> list[float]:
        """The scores of any number of words, in bounded memory."""
        return [s for i in range(0, len(words), at_once) for s in self.word_scores(words[i : i + at_once]).tolist()]

    def raw(self, texts: list[str | None], cache: dict[str, float]) -> np.ndarray:
        """Of every text the mean score of its two and of its four most toxic words, and how much longer than a paragraph it is."""
        worst, counts = np.full((len(texts), 4), self.bias), np.zeros(len(texts))
        split = {i: words_of(t) for i, t in enumerate(texts) if len(t or "") <= CHUNK_BYTES}
        if len(cache) > CACHED_WORDS:
            cache.clear()
        self._learn_words(split.values(), cache)
        for i, text in enumerate(texts):
            top: list[float] = []
            for words in [split[i]] if i in split else map(words_of, pieces(text, cut=APART)):
                if i not in split:
                    self._learn_words([words], cache)
                top = nlargest(4, chain(top, map(cache.__getitem__, words)))
                counts[i] += len(words)
            worst[i, : len(top)] = top
        worst = np.tanh(worst / 2)  # far beyond the margin a score says little more
        # The longer a text beyond a paragraph, the higher its highest scores by chance; a short one gains nothing.
        return np.column_stack([worst[:, :2].mean(1), worst.mean(1), np.log(np.maximum(counts, PARAGRAPH) / PARAGRAPH)])

    def _learn_words(self, split: Iterable[list[str]], cache: dict[str, float]) -> None:
        """Score the words that the cache doesn't have."""
        new = list(set().union(*split).difference(cache))
        cache.update(zip(new, self.all_scores(new), strict=True))

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return sigmoid(raw @ self.slopes + self.shift)


CLEAN = Toxicity(np.zeros(LETTERS**3, np.float32), -1.0, np.zeros(3), -35.0)


def calibrated(model: Toxicity, raw: np.ndarray, labels: np.ndarray, prior: float) -> Toxicity:
    """The model with a logistic curve; one half lies in the gap where the classes leave one."""
    slopes, shift = fit_sigmoid(raw, labels)
    put, shift = raw @ slopes, shift + prior
    if (labels == 0).any() and (labels == 1).any():
        low, high = np.quantile(put[labels == 0], 0.995), np.quantile(put[labels == 1], 0.01)
        if high > low:
            shift = -(low + high) / 2
    return Toxicity(model.weights, model.bias, slopes, float(shift))


def parts_of(word: str) -> set[str]:
    """The word with its ends marked, and all its parts of ``PART`` letters."""
    marked = f"^{word}$"
    return {marked, *(marked[i : i + PART] for i in range(len(marked) - PART + 1))}


def part_odds(toxic: list[set[str]], clean: list[set[str]], at_once: int = 64) -> dict[str, float]:
    """For each word of the toxic texts the log-odds of its most telling part, by texts that have the part."""

    def counted(bags: list[set[str]], known: Counter[str] | None) -> Counter[str]:
        found: Counter[str] = Counter()
        for start in range(0, len(bags), at_once):
            some = bags[start : start + at_once]
            parts = {w: parts_of(w) if known is None else parts_of(w) & known.keys() for w in set().union(*some)}
            found.update(p for bag in some for p in set().union(*map(parts.__getitem__, bag)))
        return found

    seen = counted(toxic, None)
    other = counted(clean, seen)
    odds = {p: float(np.log(n + 0.5) - np.log(other[p] + 0.5)) for p, n in seen.items()}
    return {w: max(odds[p] for p in parts_of(w)) for w in set().union(*toxic)}


def witness(bag: set[str], odds: dict[str, float], turn: int) -> str:
    """A word of a toxic text that speaks nearly as much for toxicity as its strongest one, another one each ``turn``."""
    most = max(odds[w] for w in bag)
    near = sorted(w for w in bag if odds[w] >= most - NEAR_ODDS)
    return near[turn % len(near)]


def inserted(word: str) -> list[str]:
    """The word with one letter put into each place inside it, the letters by turns."""
    return [f"{word[:i]}{chr(ord('a') + (7 * i + len(word)) % 26)}{word[i:]}" for i in range(1, len(word))]


def train_machine(points: np.ndarray, labels: np.ndarray, weights: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Linear machine with squared hinge loss in the primal: Newton steps on the violated margins, halved until they help."""
    design = np.column_stack([points, np.ones(len(points))])
    penalty = np.full(design.shape[1], ridge)
    penalty[-1] = 1e-6

    def loss(solution: np.ndarray) -> float:
        gap = np.maximum(0, 1 - labels * (design @ solution))
        return float(penalty @ solution**2 + weights @ gap**2)

    solution = np.zeros(design.shape[1])
    now = loss(solution)
    for _ in range(60):
        active = labels * (design @ solution) < 1
        chosen, w = design[active], weights[active]
        step = np.linalg.solve(np.diag(penalty) + (chosen * w[:, None]).T @ chosen, chosen.T @ (labels[active] * w)) - solution
        size = 1.0
        while size > 1e-3 and loss(solution + size * step) > now:
            size /= 2
        solution = solution + size * step
        last, now = now, loss(solution)
        if last - now <= 1e-7 * last:
            break
    return solution


def fit(sample: Sample) -> Toxicity:
    """The machine of the whole sample, calibrated on what the machines of its halves say of the other half."""
    known: dict[str, str] = {}  # equal words are one object
    bags = [{known.setdefault(w, w) for w in words_of(t)} for t in sample.texts]
    labels, half = sample.labels, sample.calibrate
    known.clear()
    model = train(bags, labels)
    if model is CLEAN:
        return CLEAN
    rows, raws = [], []
    for side in (half, ~half):
        own, other = np.flatnonzero(~side), np.flatnonzero(side)
        part = train([bags[i] for i in own], labels[own])
        if part is not CLEAN and len(other):
            raws.append(part.raw([sample.texts[i] for i in other], {}))
            rows.append(other)
    if not rows:
        rows, raws = [np.arange(len(bags))], [model.raw(sample.texts, {})]
    return calibrated(model, np.concatenate(raws), labels[np.concatenate(rows)], sample.prior)


def train(bags: list[set[str]], marks: np.ndarray, rounds: int = ROUNDS) -> Toxicity:
    """The machine without its calibration."""
    toxic = [i for i in range(len(bags)) if marks[i] == 1 and bags[i]]
    clean_bags = [b for b, mark in zip(bags, marks, strict=True) if mark == 0]
    clean = Counter(w for b in clean_bags for w in b)
    if not toxic or not clean:
        return CLEAN
    toxic_bags = [bags[i] for i in toxic]
    vocabulary = sorted(set().union(*toxic_bags))
    odds = part_odds(toxic_bags, clean_bags)
    chosen = Counter(witness(b, odds, i) for i, b in enumerate(toxic_bags))
    ordinary = sorted(clean, key=lambda w: (-clean[w], w))
    negatives, hard = dict.fromkeys(ordinary[: 8 * LANDMARKS]), ordinary[LANDMARKS :]
    model = CLEAN
    for turn in range(rounds):
        half = LANDMARKS // 2
        landmarks = [w for w, _ in sorted(chosen.items(), key=lambda x: (-x[1], x[0]))[:half]]
        landmarks += [w for w in [*ordinary[: half // 2], *hard[:half]] if w not in chosen][:half]
        codes, _ = codes_of(landmarks)
        numbers = np.unique(np.concatenate([n[t] for n, t, _ in subsequences(codes)]))
        if not len(numbers):
            return CLEAN
        columns = np.full(LETTERS**3, -1)
        columns[numbers] = np.arange(len(numbers))
        basis = kernel_rows(landmarks, columns)
        gram = (basis @ basis.T).astype(float)
        value, vector = np.linalg.eigh(gram)
        solid = value > 1e-5 * value.max()
        whiten = vector[:, solid] / np.sqrt(value[solid])
        positives = {w: float(min(n, 20)) for w, n in chosen.items()}
        for w, n in chosen.most_common(LANDMARKS):
            positives |= {v: min(n, 20) / len(w) for v in inserted(w) if v not in clean and v not in positives}
        words = [*positives, *[w for w in negatives if w not in positives]]
        to_points = basis.T @ whiten.astype(np.float32)
        points = embedded(words, columns, to_points)
        labels = np.r_[np.ones(len(positives)), -np.ones(len(words) - len(positives))]
        counts = np.r_[[*positives.values()], np.ones(len(words) - len(positives))]
        solution = train_machine(points, labels, counts)
        table = np.zeros(LETTERS**3, np.float32)
        table[numbers] = basis.T @ (whiten @ solution[:-1]).astype(np.float32)
        del basis, to_points, points
        model = Toxicity(table, float(solution[-1]), np.zeros(3), 0.0)
        # Next round: the worst clean words, and the word that now speaks most for each toxic text.
        read = ordinary[turn % PARTS :: PARTS]
        scores = dict(zip(read, model.all_scores(read), strict=True))
        hard = sorted(read, key=lambda w: (-scores[w], w))[: 2 * LANDMARKS]
        wrong = [w for w in hard if scores[w] > MARGIN and w not in negatives]
        negatives |= dict.fromkeys(hard)
        scores |= zip(vocabulary, model.all_scores(vocabulary), strict=True)
        last = chosen
        chosen = Counter(witness(b, odds, i) for i, b in enumerate(toxic_bags))
        chosen = Counter({w: n for w, n in chosen.items() if n > 1 or scores[w] > 0})
        chosen += Counter(max(sorted(b), key=scores.__getitem__) for b in toxic_bags if chosen.keys().isdisjoint(b))
        if chosen == last and not wrong:
            break
    return model


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Toxicity:
    """The model for ``docs(doc_id, text)`` with ``labels(doc_id, toxic)``, from a bounded sample."""
    return fit(sample_labelled(docs, labels, "toxic", per_class, max_chars))


def score(df: DataFrame, model: Toxicity, column: str = "text", name: str = "score") -> DataFrame:
    """Add the probability that ``column`` is toxic, over the whole text."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*[f for f in df.schema.fields if f.name.lower() != name.lower()], T.StructField(name, T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cache = shared.value, {}
        for batch in batches:
            for part in chunks(batch, column):
                found = held.probability(held.raw(values(part, column), cache))
                yield extended(part, arrow, {name: pa.array(found, pa.float64())})

    return df.mapInArrow(run, schema)
