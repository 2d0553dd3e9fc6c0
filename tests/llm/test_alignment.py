"""Cross-tokenizer alignment against a plain version that encodes every text as a whole."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tranche.llm import alignment, catalog

NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    return catalog.tokenizer_definition(), catalog.piece_model()


def plain(rows, definition, model):
    """The contract, token by token."""
    a = Tokenizer.from_str(definition)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=model)
    letters = alignment.byte_letters()

    def ends(pieces):
        at, found = 0, []
        for piece in pieces:
            at += len(piece)
            found.append(at)
        return found

    links, shown = [], []
    for _, text in rows:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([b.id_to_piece(i) and int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
            else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
        ]
        want = b" " + (text or "").encode()
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = ends(bytes_a), ends(bytes_b)
        groups, at_a, at_b = [], 0, 0
        place_a, place_b = ({e: k for k, e in enumerate(x)} for x in (ends_a, ends_b))
        for end in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = place_a[end] + 1, place_b[end] + 1
            groups.append((ids_a[at_a:to_a], ids_b[at_b:to_b]))
            at_a, at_b = to_a, to_b
        links.append(Counter((x, y) for p, q in groups for x in p for y in q))
        shown.append(groups)
    count = Counter(pair for own in links for pair in own)
    highest = {}
    for (x, _), n in count.items():
        highest[x] = max(highest.get(x, 0), n)
    result = []
    for (doc_id, _), own, groups in zip(rows, links, shown):
        text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        result.append((
            doc_id, sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), sum(own.values()),
            sum(n for pair, n in own.items() if count[pair] == highest[pair[0]]), sum(n * count[p] for p, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return result


def odd_texts(texts):
    source = random.Random(3)
    marks = ["a", "é", "▁", " ", "  ", "\n", "\t", " ", "日本", "😀", "'s", "x1", "<|endoftext|>", "<s>", "́", "ﬁ", "\r\n", "\x85", "\x1f"]
    found = [t for t in texts if t is None or len(t) < 5000]
    found += ["".join(source.choice(marks) for _ in range(source.randint(1, 30))) for _ in range(150)]
    found += ["a" * 3001, "ab" * 900 + " " + "\n" * 70, "the same", "the same", "the same", " ", "  ", "\n", " lead", "trail  ", "\x00 nul"]
    return found


@pytest.mark.parametrize("records", [2_000_000, 300])
def test_alignment(spark, texts, tokenizers, monkeypatch, records):
    rows = list(enumerate(odd_texts(texts))) + [(None, "the same"), (3, "twice"), (3, "twice")]
    monkeypatch.setattr(alignment, "SMALL_GROUP", 4)
    table = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_a string").repartition(3)
    monkeypatch.setattr(alignment, "RUN_RECORDS", records)
    found = alignment.align(table, *tokenizers)
    assert found.columns == NAMES
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(plain(rows, *tokenizers), key=key)


def test_groups(spark, tokenizers):
    table = spark.createDataFrame([(1, "the cat"), (2, "")], "doc_id long, text string")
    found = {r["doc_id"]: r["groups"] for r in alignment.align(table, *tokenizers, digest=False).collect()}
    assert found[2] == ""
    assert [g.count("|") for g in found[1].split(";")] == [1] * len(found[1].split(";"))


def test_no_documents(spark, nothing, tokenizers):
    assert alignment.align(nothing, *tokenizers).collect() == []


def test_remembered_units(tokenizers, monkeypatch):
    """Forgetting units between slices changes nothing."""
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    small, large = alignment.Aligner(*tokenizers), alignment.Aligner(*tokenizers)
    texts = ["one two three four five six", "six five 4 three", "one, two!", "x" * 200 + " one"] * 3
    for text in texts:
        a, b = small.aligned([text])[0], large.aligned([text])[0]
        assert a[2] == b[2] and a[1].tolist() == b[1].tolist() and sorted(a[0].tolist()) == sorted(b[0].tolist())


def test_long_text(spark, tokenizers):
    """A text above a megabyte, whole."""
    text = " ".join(f"word{k % 977} and" for k in range(90_000))
    assert len(text) > 1 << 20
    found = alignment.align(spark.createDataFrame([(1, text), (2, "word5")], "doc_id long, text string"), *tokenizers)
    assert sorted(map(tuple, found.collect())) == plain([(1, text), (2, "word5")], *tokenizers)
