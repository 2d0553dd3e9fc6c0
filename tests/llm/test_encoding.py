"""The remembering encoder against the library, where hashes collide and where it forgets."""

import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tranche.llm import catalog, encoding
from tranche.llm import words as W


@pytest.fixture(scope="module")
def definition():
    return catalog.tokenizer_definition()


def same(encoder, definition, texts):
    library = Tokenizer.from_str(definition)
    for text, ids in zip(texts, encoder.encode(pa.array(texts, pa.string())), strict=True):
        assert ids.tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 2]


def thue_morse(size):
    return "".join("ab"[bin(k).count("1") % 2] for k in range(size))


def test_words_of_one_hash(definition):
    """A word and its complement that have one polynomial hash modulo 2^64, for any base."""
    one = thue_morse(2048)
    other = one.translate(str.maketrans("ab", "ba"))
    texts = [one, other, f"x {one} y", f"x {other} y", f"{one} {other}", "plain <|endoftext|> text"]
    same(encoding.Encoder(definition, 2), definition, texts)
    for text in texts:
        same(encoding.Encoder(definition, 2), definition, [text])


def test_forgetting(definition, monkeypatch):
    monkeypatch.setattr(encoding, "REMEMBERED", 60)
    monkeypatch.setattr(encoding, "PIECE_BYTES", 200)
    monkeypatch.setattr(encoding, "LEARNED", 7)
    source = random.Random(2)
    words = [" ".join("".join(source.choice("abcdeé'1, ") for _ in range(9)) for _ in range(12)) for _ in range(150)]
    encoder = encoding.Encoder(definition, 2)
    same(encoder, definition, words * 2)
    assert len(encoder.known) < 400


def test_one_encoder_for_a_worker(definition):
    assert encoding.encoder(definition, 2) is encoding.encoder(definition, 2)
    assert encoding.encoder(definition, 3) is not encoding.encoder(definition, 2)


def test_long_text(definition):
    text = " ".join(f"word{k} and" for k in range(120_000))
    assert len(text) > 1 << 20
    same(encoding.Encoder(definition, 2), definition, ["", None, text, "after"])


def test_idle_memory_is_dropped(definition):
    """Text that other operators handle empties what the encoder remembers; ids stay the same."""
    encoder = encoding.Encoder(definition, 2)
    texts = ["some words, and some more", "x" * 300_000 + " words"]
    for _ in range(3):  # its own text does not
        same(encoder, definition, texts)
    assert encoder.known
    for _ in W.pieces(pa.array(["y" * (W.IDLE_BYTES // 2)] * 2)):
        assert encoder.known
    assert not encoder.known and not len(encoder.flat)
    same(encoder, definition, texts)
