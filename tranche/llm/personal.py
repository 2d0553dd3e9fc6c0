"""Personal data in texts: fixed forms, and identifiers learned from the words around them.

E-mail addresses, IP addresses, card and phone numbers of fixed form are base spans; they always count.
They are also the seeds of a bootstrap. Every other token that looks like an identifier is a candidate.
An occurrence of either induces lexical patterns: the two words before it, the word on either side, the
two words after it. Patterns and instances form a graph, counted over all documents, and are scored in
rounds: a pattern's confidence for a kind is the share of that kind among its distinct instances (with
``DOUBT`` more against it); an instance that patterns of ``CONFIDENT`` or more hold is taken as an
instance of their kind, scored by noisy-or, and counts with that score in the next round. All occurrences
of the instances found so are added spans.

What has the look of a kind but fails its check (such as a card number with a wrong check digit) counts
against patterns and is never added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tranche.session import settle

#: Kinds in the order in which spans with one start are listed.
KINDS = ("email", "ip", "card", "phone")
ROUNDS, CONFIDENT, DOUBT = 4, 0.8, 2.0
#: A candidate has at least so many characters, and a digit.
SHORTEST = 5
FAILED, UNKNOWN = -1, -2

# The fixed forms. A form begins where a run of its characters does, so no character is tried twice.
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"\S+")
DIGIT = re.compile(r"[0-9]")
EDGES = "\"'()[]{}<>,;:!?*#$%&|=`~^\\/._-"


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    doubled = (int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits)))
    return sum(x // 10 + x % 10 for x in doubled) % 10 == 0


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Base spans as (start, kind, end), sorted, and the spans that have a form but fail its check."""
    good, failed = [], []
    if "@" in text:
        last = 0
        for found in HOST.finditer(text):
            start = found.start()
            while start > last and LOCAL.match(text, start - 1):
                start -= 1
            if start < found.start():
                good.append((start, 0, found.end()))
                last = found.end()

    def judge(kind: int, found: re.Match, ok: bool) -> None:
        if ok:
            good.append((found.start(), kind, found.end()))
        else:
            failed.append(found.span())

    for found in IP.finditer(text):
        parts = [p.lstrip("0") for p in found.group().split(".")]
        judge(1, found, all(len(p) <= 3 and int(p or 0) <= 255 for p in parts))
    for found in CARD.finditer(text):
        digits = found.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 or len(found.group()) >= SHORTEST:
            judge(2, found, 14 <= len(digits) <= 19 and luhn(digits))
    if "+" in text:
        for found in PHONE.finditer(text):
            judge(3, found, 10 <= sum(map(found.group().count, "0123456789")) <= 15)
    # A number of another length only has the look of a card; it may still be an identifier.
    failed = [s for s in failed if _looks_like(text[s[0]:s[1]])]
    return sorted(good), failed


def _looks_like(value: str) -> bool:
    digits = sum(map(value.count, "0123456789"))
    return value.count(".") == 3 or 14 <= digits <= 19


def word(token: str) -> str:
    """A word of a pattern: without signs at its edges, lower-case, digits as 0."""
    return DIGIT.sub("0", token.strip(EDGES).lower())[:40]


def occurrences(text: str, good: list[tuple[int, int, int]], failed: list[tuple[int, int]]):
    """(start, end, label, value, patterns) of each seed, failed form and candidate."""
    if not good and not DIGIT.search(text):
        return []
    seeds = sorted([(s, e, k) for s, k, e in good] + [(s, e, FAILED) for s, e in failed])
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
    found, at, free = [], 0, 0
    for n, (start, end) in enumerate(tokens):
        while at < len(seeds) and seeds[at][0] < end:
            s, e, label = seeds[at]
            free = max(free, e)
            at += 1
            last = n
            while last + 1 < len(tokens) and tokens[last][1] < e:
                last += 1
            found.append((s, e, label, n, last))
        if start < free:
            continue
        raw = text[start:end]
        value = raw.strip(EDGES)
        if len(value) >= SHORTEST and DIGIT.search(value):
            begin = start + raw.index(value)
            found.append((begin, begin + len(value), UNKNOWN, n, n))
    result = []
    for s, e, label, first, last in found:
        before = [word(text[a:b]) for a, b in tokens[max(0, first - 2):first]]
        after = [word(text[a:b]) for a, b in tokens[last + 1:last + 3]]
        patterns = []
        if len(before) == 2:
            patterns.append(f"{before[0]} {before[1]} _")
        if before and after:
            patterns.append(f"{before[-1]} _ {after[0]}")
        if len(after) == 2:
            patterns.append(f"_ {after[0]} {after[1]}")
        result.append((s, e, label, text[s:e], [p for p in patterns if re.search(r"\w", p.replace("_", ""))]))
    return result


SPAN = "struct<start:int,kind:int,end:int>"
FOUND = f"base array<{SPAN}>, seen array<struct<start:int,end:int,label:int,value:string,patterns:array<string>>>"


def scanned(documents: DataFrame) -> DataFrame:
    """row (a number), doc_id, base and seen (every seed, failed form and candidate with its patterns; its
    value as a hash) of each document."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    seen = pa.struct([
        ("start", pa.int32()), ("end", pa.int32()), ("label", pa.int32()), ("value", pa.string()),
        ("patterns", pa.list_(pa.string())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, all_seen = [], []
            for text in batch.column("text"):
                text = text.as_py()
                good, failed = base_spans(text)
                bases.append([{"start": s, "kind": k, "end": e} for s, k, e in good])
                all_seen.append([
                    {"start": s, "end": e, "label": label, "patterns": patterns,
                     "value": hashlib.sha256(value.encode()).hexdigest()[:32]}
                    for s, e, label, value, patterns in occurrences(text, good, failed)
                ])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(bases, pa.list_(span)), pa.array(all_seen, pa.list_(seen))],
                ["doc_id", "base", "seen"],
            )

    found = rows.mapInArrow(run, f"doc_id long, {FOUND}")
    return settle(found.withColumn("row", F.monotonically_increasing_id()))


def bootstrapped(scan: DataFrame, rounds: int = ROUNDS, confident: float = CONFIDENT, doubt: float = DOUBT) -> DataFrame:
    """Instances that patterns discover: value, kind, score.

    The graph holds each pair of pattern and instance once, however often it occurs, so copies of a
    document add nothing. An instance with several labels has the least one; a failed form loses to none.
    Stops when a round finds nothing new, after ``rounds`` at the latest.
    """
    seen = scan.select(F.explode("seen").alias("x")).select("x.label", "x.value", "x.patterns")
    labels = seen.groupBy("value").agg(F.max("label").alias("label"))
    edges = settle(seen.select("value", F.explode("patterns").alias("pattern")).distinct())
    labels = settle(labels)
    count = len(KINDS)
    # A pattern of fewer instances cannot reach the confidence, whatever they are.
    least = confident * doubt / (1 - confident) - 1e-9
    common = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("pattern")
    graph = settle(edges.join(common, "pattern", "left_semi").join(labels, "value"))
    known = None
    for _ in range(rounds):
        rows = graph if known is None else graph.join(known, "value", "left")
        kind = F.when(F.col("label") >= 0, F.col("label"))
        if known is not None:
            kind = F.coalesce(kind, F.col("kind"))
        weight = F.lit(1.0) if known is None else F.coalesce(F.when(F.col("label") < 0, F.col("score")), F.lit(1.0))
        rows = rows.withColumn("as", kind).withColumn("weight", weight)
        shares = [F.sum(F.when(F.col("as") == k, F.col("weight")).otherwise(0.0)).alias(f"of{k}") for k in range(count)]
        patterns = rows.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *shares)
        best = F.greatest(*[F.col(f"of{k}") for k in range(count)])
        chosen = F.coalesce(*[F.when(F.col(f"of{k}") == best, F.lit(k)) for k in range(count)])
        patterns = patterns.select("pattern", chosen.alias("pattern_kind"), (best / (F.col("n") + doubt)).alias("confidence"))
        patterns = patterns.where(F.col("confidence") >= confident)
        unknown = graph.where(F.col("label") == UNKNOWN).select("value", "pattern")
        miss = F.exp(F.sum(F.log(1 - F.col("confidence"))))
        scores = unknown.join(patterns, "pattern").groupBy("value", "pattern_kind").agg((1 - miss).alias("score"))
        top = F.max(F.struct("score", -F.col("pattern_kind")))
        scores = scores.groupBy("value").agg(top.alias("top"))
        before = 0 if known is None else known.count()
        known = settle(scores.select("value", (-F.col("top.col2")).alias("kind"), F.col("top.score").alias("score")))
        if known.count() == before:
            break
    return known


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, sorted and joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(shown, ",")


def personal_spans(documents: DataFrame, **settings) -> DataFrame:
    """Personal data of every whole text of ``documents`` (doc_id, text; other columns are not read).

    One row per row: doc_id, base and spans, both arrays of (start, kind, end): code points, the end
    exclusive, ``kind`` an index of ``KINDS``. ``base`` has the fixed forms, ``spans`` those and the learned
    ones. A null text is an empty one and has no span; repeated rows and rows without doc_id each have
    their own. ``settings`` are those of ``bootstrapped``.
    """
    scan = scanned(documents)
    found = bootstrapped(scan, **settings)
    new = scan.select("row", F.explode("seen").alias("x")).where(F.col("x.label") == UNKNOWN)
    new = new.select("row", "x.start", "x.end", F.col("x.value").alias("value")).join(found, "value")
    added = new.groupBy("row").agg(F.collect_list(F.struct("start", F.col("kind").cast("int").alias("kind"), "end")).alias("added"))
    rows = scan.select("row", "doc_id", "base").join(added, "row", "left")
    none = F.array().cast(f"array<{SPAN}>")
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans"))
