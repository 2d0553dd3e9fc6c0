"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding lowers letters, takes letters of any plane apart (ligatures, mathematical letters), drops
marks and format characters, replaces look-alikes of other scripts, and reads the digits and signs of
a word that has letters as the letters they stand for. Lexicon entries are whole words
or beginnings of words; each has a weight. A match inside an exception phrase counts nothing. The
sum of the weights and its share of the document's words give a calibrated score.

Entries, weights, exceptions and the calibration are learned from labelled documents: entries by
sequential covering, so that a word which merely accompanies another in copies of one document is
not taken.
"""

from __future__ import annotations

import heapq
import math
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tranche.llm import words as W
from tranche.llm.frames import fresh, with_columns
from tranche.llm.labelled import balanced, training_sample

#: Labelled documents of each class to learn from, at most.
PER_CLASS = 8_000
#: Counts that a task holds before it passes them on.
HELD = 200_000
#: Toxic documents that an entry must explain beyond those already explained; one is enough for an
#: entry that COMMON of all toxic documents have.
SUPPORT = 3
COMMON = 0.01
#: Least odds of an entry, in favour of toxic documents.
ODDS = 4.0
STEMS = range(4, 9)

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ѵ": "v", "α": "a", "β": "b", "ε": "e",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l",
    "ø": "o", "đ": "d",
}
# Digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
BLANK = 32


@lru_cache(maxsize=1 << 16)
def folded_char(char: str) -> str:
    """What a character is in a word: its compatibility decomposition in lower case, without marks and
    format characters (such as soft hyphens and zero-width ones), look-alikes replaced, and a space for
    all that is no part of a word. Nothing for a mark or format character alone."""
    parts = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", char).lower())
    found = ""
    for part in parts:
        if unicodedata.category(part)[0] == "M" or unicodedata.category(part) == "Cf":
            continue
        part = LOOK_ALIKES.get(part, part)
        found += part if part.isalnum() or part in SUBSTITUTES else " "
    return found if found.strip() else found[:1]


@lru_cache(maxsize=1)
def folding() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each character of the basic plane its folded form, whether that is a letter, the letter it
    stands for in a word, and whether it folds to one character (if not, see folded_char)."""
    size = 1 << 16
    folded = np.full(size, BLANK, np.uint32)
    letter, single = np.zeros(size, bool), np.ones(size, bool)
    for code in range(size):
        if 0xD800 <= code < 0xE000:
            continue
        found = folded_char.__wrapped__(chr(code))
        single[code] = len(found) == 1
        if single[code]:
            folded[code], letter[code] = ord(found), found.isalpha()
    stands = np.arange(size, dtype=np.uint32)
    for sign, char in SUBSTITUTES.items():
        stands[ord(sign)] = ord(char)
    return folded, letter, stands, single


def folded_codes(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded forms of ``codes``, whether each is a letter, and where ``ends`` come to lie."""
    folded, letter, _, single = folding()
    near = np.minimum(codes, 0xFFFF)
    result, is_letter = folded[near], letter[near]
    odd = np.flatnonzero((codes > 0xFFFF) | ~single[near])
    if not len(odd):
        return result, is_letter, ends
    distinct, which = np.unique(codes[odd], return_inverse=True)
    forms = [folded_char(chr(c)) for c in distinct.tolist()]
    sizes = np.array([len(f) for f in forms], np.int64)
    flat = np.array([ord(c) for f in forms for c in f], np.uint32)
    alpha = np.array([c.isalpha() for f in forms for c in f], bool)
    lengths = np.ones(len(codes), np.int64)
    lengths[odd] = sizes[which]
    reached = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(lengths, out=reached[1:])
    result, is_letter = np.repeat(result, lengths), np.repeat(is_letter, lengths)
    # Character k of a form comes from place k behind where the form begins.
    own = sizes[which]
    inside = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
    to = np.repeat(reached[odd], own) + inside
    source = np.repeat((np.cumsum(sizes) - sizes)[which], own) + inside
    result[to], is_letter[to] = flat[source], alpha[source]
    return result, is_letter, reached[ends]


def folded_texts(texts: pa.Array) -> Iterator[str]:
    """Each text as folded words, with one space before, between and after them."""
    stands = folding()[2]
    for piece in W.pieces(texts, lower=False):
        lead = (piece.data & 0xC0) != 0x80
        places = np.zeros(len(piece.data) + 1, np.int64)
        np.cumsum(lead, out=places[1:])
        # A space goes behind every document, so words end with it.
        codes = np.frombuffer(piece.data.tobytes().decode().encode("utf-32-le"), np.uint32)
        codes = np.insert(codes, places[piece.starts[1:]], BLANK)
        ends = places[piece.starts[1:]] + np.arange(1, len(piece.starts))
        codes, is_letter, ends = folded_codes(codes, ends)
        inside = codes != BLANK
        change = np.flatnonzero(np.diff(inside, prepend=False))
        if len(change):
            spelled = np.logical_or.reduceat(is_letter, change)
            run = np.repeat(spelled, np.diff(np.append(change, len(codes))))
            run = np.concatenate((np.zeros(change[0], bool), run))
            codes = np.where(run & (codes <= 0xFFFF), stands[np.minimum(codes, 0xFFFF)], codes)
            # Signs that stand for nothing here are no part of a word.
            codes = np.where(~run & ((codes == ord("@")) | (codes == ord("$"))), BLANK, codes)
        inside = codes != BLANK
        keep = inside.copy()
        keep[1:] |= inside[:-1]  # of several spaces the first
        kept = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(keep, out=kept[1:])
        text = codes[keep].astype("<u4").tobytes().decode("utf-32-le")
        cuts = kept[np.concatenate(([0], ends))]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield " " + text[a:b].lstrip(" ")


@dataclass
class Lexicon:
    """Entries (a word's beginning has a space before it, a whole word one behind it too), their
    weights, exception phrases, and the calibration's intercept and two slopes."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    calibration: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:  # a phrase excuses what it spans, also if it is an entry itself
            found.add_word(phrase, (len(phrase), None))
        found.make_automaton()
        return found


def found_in(automaton, text: str) -> dict[int, tuple[int, float]]:
    """Length and weight of the heaviest entry at each place of a folded text, outside exceptions."""
    best: dict[int, tuple[int, float]] = {}
    excused = []
    for end, (size, weight) in automaton.iter(text):
        start = end - size + 1
        if weight is None:
            excused.append((start, end))
        elif start not in best or (weight, size) > best[start][::-1]:
            best[start] = (size, weight)
    if excused:
        covered = np.zeros(len(text) + 1, np.int32)
        for start, end in excused:
            covered[start] += 1
            covered[end] -= 1
        covered = np.cumsum(covered)
        best = {s: x for s, x in best.items() if not covered[s]}
    return best


def mass(automaton, text: str) -> float:
    """The summed weight of the entries found."""
    return sum(weight for _, weight in found_in(automaton, text).values())


def measured(documents: DataFrame, lexicon: Lexicon) -> tuple[DataFrame, list[str]]:
    """Add the weight found and the number of words (names returned)."""
    shared = documents.sparkSession.sparkContext.broadcast((lexicon.weights, lexicon.exceptions))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        weights, exceptions = shared.value
        automaton = Lexicon(weights, exceptions).automaton() if weights else None
        masses, counts = [], []
        for text in folded_texts(batch.column("text")):
            masses.append(mass(automaton, text) if automaton else 0.0)
            counts.append(max(0, text.count(" ") - 1))
        return [pa.array(masses, pa.float64()), pa.array(counts, pa.int64())]

    return with_columns(documents, "toxic_weight double, toxic_words long", compute)


def features(weight: Column, words: Column) -> list[Column]:
    return [F.log1p(weight), F.log1p(weight * 1000.0 / F.greatest(words, F.lit(1)))]


def score(lexicon: Lexicon, weight: Column, words: Column) -> Column:
    base, *slopes = lexicon.calibration
    total = F.lit(base)
    for slope, feature in zip(slopes, features(weight, words)):
        total = total + F.lit(slope) * feature
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def entries_of(text: str) -> set[str]:
    """Candidate entries of a folded text."""
    found = set()
    for word in set(text.split()):
        if not word.isdigit():
            found.add(f" {word} ")
            found.update(" " + word[:k] for k in STEMS if k <= len(word))
    return found


def candidates(distinct: DataFrame, n_toxic: int, n_clean: int) -> tuple[dict[str, int], dict[str, int]]:
    """In how many toxic and in how many clean documents each entry is that has the support and the odds."""
    sums = class_sums(by_class(distinct, lambda _, text: entries_of(text), lambda: None))
    odds = (F.col("toxic") + 0.5) / (n_toxic + 1) / ((F.col("clean") + 0.5) / (n_clean + 1))
    # As many as the bounded sample gives.
    good = sums.where((F.col("toxic") >= SUPPORT) & (odds >= ODDS)).collect()
    return {r["item"]: r["toxic"] for r in good}, {r["item"]: r["clean"] for r in good}


def incidence(sample: DataFrame, entries: list[str]) -> list[np.ndarray]:
    """Which of ``entries`` each document of the bounded sample has."""
    shared = sample.sparkSession.sparkContext.broadcast({e: k for k, e in enumerate(entries)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            found = [
                np.array(sorted(number[e] for e in entries_of(t) if e in number), np.int32).tobytes()
                for t in folded_texts(batch.column("text"))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["entries"])

    rows = sample.select("text").mapInArrow(run, "entries binary").collect()
    return [np.frombuffer(r[0], np.int32) for r in rows]


def cover(documents: list[np.ndarray], weight: list[float], prefer: list[tuple]) -> list[int]:
    """Entries, each of which explains the most documents that the ones before it left over."""
    entry = np.concatenate([np.zeros(0, np.int32), *documents])
    doc = np.repeat(np.arange(len(documents)), [len(x) for x in documents])
    doc = doc[np.argsort(entry, kind="stable")]
    total = np.bincount(entry, minlength=len(weight))
    begin = np.cumsum(total) - total
    rank = {e: k for k, e in enumerate(sorted(range(len(weight)), key=lambda e: prefer[e], reverse=True))}
    left = np.ones(len(documents), bool)
    # What an entry explains only shrinks, so the first whose figure is still right is the best.
    waiting = [(-float(total[e] * weight[e]), -int(total[e]), rank[e], e) for e in rank if total[e]]
    heapq.heapify(waiting)
    chosen = []
    while waiting:
        known, _, _, best = waiting[0]
        own = doc[begin[best]:begin[best] + total[best]]
        gained = int(left[own].sum())
        if not gained or (gained < SUPPORT and total[best] < COMMON * len(documents)):
            heapq.heappop(waiting)
        elif -float(gained * weight[best]) != known:
            heapq.heapreplace(waiting, (-float(gained * weight[best]), -int(total[best]), rank[best], best))
        else:
            heapq.heappop(waiting)
            chosen.append(best)
            left[own] = False
    return chosen


def learn(documents: DataFrame, labels: DataFrame, usable: Column, per_class: int = PER_CLASS) -> Lexicon:
    """A lexicon from the labelled documents for which ``usable`` (a condition on ``labels``) holds.

    At most ``per_class`` documents of each class are used; equal texts count once. Without toxic
    ones the lexicon is empty and every score is that of a document without matches.
    """
    sample = training_sample(documents, labels, "toxic", usable, per_class)
    distinct = sample.groupBy("text").agg(F.max("label").alias("label"))
    sizes = {r["label"]: r["n"] for r in distinct.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1.0, 0), sizes.get(0.0, 0)
    if not n_toxic:
        return Lexicon({}, [], (-4.0, 1.0, 1.0))
    in_toxic, in_clean = candidates(distinct, n_toxic, n_clean)
    weight = weights_of(in_toxic, in_clean, n_toxic, n_clean)
    entries = sorted(weight)
    # Of equally good entries a whole word, then the longest stem that explains as much.
    prefer = [(e.endswith(" "), len(e), e) for e in entries]
    chosen = [entries[k] for k in cover(incidence(distinct.where("label = 1"), entries), [weight[e] for e in entries], prefer)]
    # With the exceptions known, the entries are weighed again.
    exceptions = exceptions_in(distinct, chosen, n_toxic, n_clean)
    found = matching(distinct, chosen, exceptions)
    weight = weights_of(found[1.0], found[0.0], n_toxic, n_clean)
    kept = {e: weight[e] for e in chosen if weight.get(e, 0.0) >= math.log(ODDS)}
    return calibrated(sample, Lexicon(kept, exceptions))


def weights_of(in_toxic: dict[str, int], in_clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Log odds of each entry of the toxic documents."""
    return {
        e: math.log((n + 0.5) / (n_toxic + 1) / ((in_clean.get(e, 0) + 0.5) / (n_clean + 1)))
        for e, n in in_toxic.items()
    }


def by_class(distinct: DataFrame, items_of: Callable[[object, str], set[str]], automaton: Callable) -> DataFrame:
    """How many documents of each class have each item that ``items_of`` finds in their folded texts."""

    def batch_of(counts: Counter) -> pa.RecordBatch:
        labels, items = zip(*counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(labels, pa.float64()), pa.array(items, pa.string()), pa.array(counts.values(), pa.int64())],
            ["label", "item", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, counts = automaton(), Counter()
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), folded_texts(batch.column("text"))):
                counts.update((label, item) for item in items_of(machine, text))
                if len(counts) > HELD:
                    yield batch_of(counts)
                    counts = Counter()
        if counts:
            yield batch_of(counts)

    found = distinct.select("label", "text").mapInArrow(run, "label double, item string, n long")
    return found.groupBy("label", "item").agg(F.sum("n").alias("n"))


def class_sums(counts: DataFrame) -> DataFrame:
    """(item, clean, toxic): the counts of both classes side by side."""
    return counts.groupBy("item").agg(
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean"),
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
    )


def exceptions_in(distinct: DataFrame, entries: list[str], n_toxic: int, n_clean: int) -> list[str]:
    """Words that hold an entry, and such words with a neighbour, that several clean documents have
    and that do not speak for a toxic one."""
    if not entries:
        return []

    def phrases(automaton, text: str) -> set[str]:
        own = set()
        for end, (size, _) in automaton.iter(text):
            start = end - size + 1
            stop = text.index(" ", start + 1)
            before, after = text.rfind(" ", 0, start), text.find(" ", stop + 1)
            own.add(text[start:stop + 1])
            if before >= 0:
                own.add(text[before:stop + 1])
            if after >= 0:
                own.add(text[start:after + 1])
        return own

    counts = by_class(distinct, phrases, lambda: Lexicon(dict.fromkeys(entries, 1.0)).automaton())
    sums = class_sums(counts)
    odds = (F.col("toxic") + 0.5) / (n_toxic + 1) / ((F.col("clean") + 0.5) / (n_clean + 1))
    good = sums.where((F.col("clean") >= SUPPORT) & (odds <= 1.0)).orderBy(F.desc("clean"), "item")
    return [r["item"] for r in good.collect()]


def matching(distinct: DataFrame, entries: list[str], exceptions: list[str]) -> dict[float, dict[str, int]]:
    """How many documents of each class an entry is found in, outside the exceptions."""
    result: dict[float, dict[str, int]] = {0.0: {}, 1.0: {}}
    if entries:
        lexicon = Lexicon(dict.fromkeys(entries, 1.0), exceptions)

        def matches(automaton, text: str) -> set[str]:
            return {text[s:s + n] for s, (n, _) in found_in(automaton, text).items()}

        for row in by_class(distinct, matches, lexicon.automaton).collect():
            result[row["label"]][row["item"]] = row["n"]
    return result


def calibrated(sample: DataFrame, lexicon: Lexicon) -> Lexicon:
    """Fit the calibration by logistic regression with both classes weighing the same."""
    rows, (weight, words) = measured(balanced(sample), lexicon)
    x, y = features(F.col(weight), F.col(words))
    rows = rows.select("label", "weight", x.alias("x"), y.alias("y"))
    rows = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(rows)
    fitted = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=50).fit(rows.cache())
    rows.unpersist()
    return Lexicon(lexicon.weights, lexicon.exceptions, (float(fitted.intercept), *map(float, fitted.coefficients)))


def scored(documents: DataFrame, lexicon: Lexicon) -> tuple[DataFrame, str]:
    """Add the score (0 to 1; name returned). Null and empty texts have no matches; repeated rows are
    scored each; a column of the same name stays and the new one gets an underscore."""
    rows, (weight, words) = measured(documents, lexicon)
    name = fresh("score", documents.columns)
    return rows.withColumn(name, score(lexicon, F.col(weight), F.col(words))).drop(weight, words), name


def accepted(documents: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """The documents whose score stays below the threshold."""
    rows, name = scored(documents, lexicon)
    return rows.where(F.col(name) < threshold).select(*documents.columns)
