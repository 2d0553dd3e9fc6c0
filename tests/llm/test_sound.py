"""Cases that once gave wrong results: equal polynomial hashes, blocks that lie crosswise, items without id."""

import random

import numpy as np

from tranche.llm import decontaminate, jaccard, lines
from tranche.llm import words as W


def thue_morse(length: int) -> tuple[str, str]:
    """Two texts that every polynomial modulo 2 ** 64 gives the same value."""
    bits = [bin(k).count("1") % 2 for k in range(length)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def sentence(seed: int, words: int) -> str:
    return " ".join(f"s{seed}w{k}" for k in range(words))


def test_span_hashes_tell_spans_apart():
    for length in (1024, 4096):
        data = np.frombuffer("".join(thue_morse(length)).encode(), np.uint8)
        first, second = W.span_hashes(data, np.array([0, length]), np.array([length, 2 * length]))
        assert first != second
    source = np.random.default_rng(3)
    for data in (source.integers(0, 256, 5000).astype(np.uint8), source.integers(0, 1 << 63, 5000).astype(np.uint64)):
        doubled = np.concatenate((data, data))
        begin = source.integers(0, 4000, 300)
        end = begin + source.integers(0, 900, 300)
        assert (W.span_hashes(doubled, begin, end) == W.span_hashes(doubled, begin + 5000, end + 5000)).all()
        spans = {tuple(data[b:e].tolist()) for b, e in zip(begin, end)}
        assert len(set(W.span_hashes(data, begin, end).tolist())) == len(spans)


def test_sums_above_the_unreduced_length(monkeypatch):
    data = np.random.default_rng(4).integers(0, 256, 3000).astype(np.uint8)
    begin, end = np.arange(0, 2900), np.arange(100, 3000)
    short = W.span_hashes(data, begin, end)
    monkeypatch.setattr(W, "UNREDUCED", 10)
    assert (W.span_hashes(data, begin, end) == short).all()


def test_lookalike_words_link_nothing(spark):
    a, b = thue_morse(1024)
    rows = [(1, f"one two three four {a}"), (2, f"one two three four {b}")]
    found = jaccard.linked_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {1: 1, 2: 2}


def test_lookalike_lines_stay(spark):
    a, b = thue_morse(1024)
    rows = [(1, f"{sentence(1, 60)} {a}"), (2, f"{sentence(1, 60)} {b}"), (3, f"{sentence(1, 60)} {a}\nown")]
    found = lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))[0]
    got = {r["doc_id"]: r["text"] for r in found.collect()}
    assert got == {1: rows[0][1], 2: rows[1][1], 3: "own"}


def test_blocks_in_another_order(spark):
    """Document 1 has both blocks in one order, all others in the other one: both go from all of them."""
    a = "\n".join(sentence(k, 12) for k in range(6))
    b = "\n".join(sentence(10 + k, 12) for k in range(7))
    rows = [(1, f"{b}\nbetween\n{a}"), *[(k, f"{a}\nown {k}\n{b}") for k in range(2, 12)]]
    found = lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))[0]
    got = {r["doc_id"]: r["text"] for r in found.collect()}
    assert got == {i: t if i == 1 else f"own {i}" for i, t in rows}


def test_every_line_in_a_shared_run_goes(spark):
    """Against all pairs, on texts of few different lines, so that blocks repeat and cross."""
    source = random.Random(5)
    pool = [sentence(k, source.choice((3, 20, 30, 55))) for k in range(12)]
    rows = [(k, "\n".join(source.choice(pool) for _ in range(source.randint(1, 14)))) for k in range(80)]
    found = lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))[0]
    got = {r["doc_id"]: r["text"] for r in found.collect()}
    split = [t.split("\n") for _, t in rows]

    def runs(own):
        for i in range(len(own)):
            for j in range(i + 1, len(own) + 1):
                if sum(len(x.split()) for x in own[i:j]) >= lines.MIN_WORDS:
                    yield i, j

    held: set[tuple[str, ...]] = set()
    for k, own in enumerate(split):
        spans = list(runs(own))
        gone = {x for i, j in spans if tuple(own[i:j]) in held for x in range(i, j)}
        assert got[k] == "\n".join(x for n, x in enumerate(own) if n not in gone), k
        held.update(tuple(own[i:j]) for i, j in spans)


def test_input_columns_named_like_inner_ones(spark):
    rows = [(1, sentence(1, 60), 7), (2, f"{sentence(1, 60)}\nown", 8)]
    for name in ("__id", "__hash", "__gone", "__words", "__away"):
        documents = spark.createDataFrame(rows, f"doc_id long, text string, {name} long")
        cleaned = lines.deduplicated(documents)[0]
        assert {r["doc_id"]: (r["text"], r[name]) for r in cleaned.collect()} == {1: (rows[0][1], 7), 2: ("own", 8)}
    assert sorted(r["__away"] for r in jaccard.deduplicated(documents).collect()) == [7]


def test_items_without_id_are_searched(spark, monkeypatch):
    documents = spark.createDataFrame([(1, f"x {sentence(1, 13)} y"), (2, sentence(2, 30))], "doc_id long, text string")
    items = [(None, sentence(1, 13)), (5, sentence(3, 13)), (6, sentence(4, 20))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for limit in (1 << 20, 100):  # in one pass and in several
        monkeypatch.setattr(decontaminate, "PASS_BYTES", limit)
        judged, names = decontaminate.contamination(documents, benchmark)
        found = {r["doc_id"]: tuple(r[n] for n in names if n != "items_sha256") for r in judged.collect()}
        assert found == {1: (15, 13, 0, True), 2: (30, 0, 0, False)}
