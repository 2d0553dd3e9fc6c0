"""Encoding many texts with a tokenizers file.

A byte-level tokenizer first cuts a text into pre-tokens and then encodes each for itself. Prose
repeats its pre-tokens, so here they are cut in numpy, many documents at a time, and only those not
met before go through the library. A worker keeps one encoder for all its tasks. Pre-tokens are told
apart by their text: hashes only group those of one piece, and each is compared with the one that stands
for its group. Which characters are letters, digits or white space is asked of
the library. Texts with characters from FAST_LIMIT on or with the content of an added token (such as
a literal <|endoftext|>, which the library makes one id), and tokenizers of another build, are
encoded by the library as a whole; ids are the same either way.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa

from tranche.llm import words as W

FAST_LIMIT = 0x250
#: Pre-tokens remembered by a worker; beyond that, those not met since the last time are forgotten.
REMEMBERED = 400_000
PIECE_BYTES = 1 << 19
#: Pre-tokens encoded in one call.
LEARNED = 2_000
LETTER, DIGIT, SPACE, OTHER = 0, 1, 2, 3
#: Contractions that the pattern cuts off, by their first letter: fixed values of the byte-level pattern.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


class Encoder:
    """Encodes text columns into id arrays, with ``end_id`` after each document."""

    def __init__(self, definition: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task on each core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values() if t.content]
        self.end_id = end_id
        self.kind = np.uint16 if max(self.library.get_vocab_size(), end_id + 1) <= 1 << 16 else np.uint32
        parts = json.loads(definition)
        before = parts.get("pre_tokenizer") or {}
        self.fast = (
            before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and not parts.get("normalizer")
        )
        if self.fast:
            tokens = self.library.get_vocab()  # a character of a token stands for a byte
            self.widths = np.zeros(max(tokens.values()) + 1, np.int64)
            self.widths[list(tokens.values())] = [len(x) for x in tokens]
            self.classes = np.array([self._class(chr(c)) for c in range(FAST_LIMIT)], np.uint8)
        self._empty()

    def _empty(self) -> None:
        """Forget all pre-tokens."""
        self.known: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.met = np.zeros(0, self.kind), np.zeros(0, bool)

    def _forget(self) -> None:
        """Keep the pre-tokens met since the last time; of more than half the room only the last ones."""
        kept = np.flatnonzero(self.met)[-REMEMBERED // 2:]
        place = np.full(len(self.met), -1)
        place[kept] = np.arange(len(kept))
        place = place.tolist()
        self.known = {text: place[k] for text, k in self.known.items() if place[k] >= 0}
        lengths, starts = self.lengths[kept], self.starts[kept]
        self.flat = self.flat[gathered(starts, lengths)]
        self.starts, self.lengths = np.cumsum(lengths) - lengths, lengths
        self.met = np.zeros(len(kept), bool)

    def _class(self, char: str) -> int:
        def whole(text: str) -> bool:
            return len(self.library.pre_tokenizer.pre_tokenize_str(text)) == 1

        # A letter, digit or sign holds together with others of its class on either side.
        for kind, sample in ((LETTER, "a"), (DIGIT, "1"), (OTHER, ".")):
            if whole(sample + char + sample):
                return kind
        return SPACE

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text (null: empty), the end id included."""
        result: list[np.ndarray] = []
        for piece in W.pieces(texts, PIECE_BYTES, lower=False):
            result += self._piece(piece)
            W.in_use(self._empty)
        return result

    def _whole(self, text: str) -> np.ndarray:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array([*ids, self.end_id], self.kind)

    def _piece(self, piece: W.Piece) -> list[np.ndarray]:
        text = piece.data.tobytes().decode()
        lead = (piece.data & 0xC0) != 0x80  # bytes that begin a character
        places = np.zeros(len(piece.data) + 1, np.int64)
        np.cumsum(lead, out=places[1:])
        starts = places[piece.starts]
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if not self.fast:
            return [self._whole(text[a:b]) for a, b in zip(starts[:-1], starts[1:])]
        far = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(codes >= FAST_LIMIT, out=far[1:])
        slow = far[starts[1:]] > far[starts[:-1]]
        for content in self.added:
            at = text.find(content)
            while at >= 0:
                doc = int(np.searchsorted(starts, at, "right")) - 1
                slow[doc] = True  # also if it runs over the document's end, which changes no id
                at = text.find(content, int(starts[doc + 1]))
        begins = self._cut(codes, starts, slow)
        ends = np.append(begins[1:], len(codes))
        counts = np.searchsorted(begins, starts)
        hashes = W.span_hashes(codes, begins, ends)
        keep = np.repeat(~slow, np.diff(counts))
        unique, first, back = np.unique(hashes[keep], return_index=True, return_inverse=True)
        own, model = (begins[keep], ends[keep]), first[back]
        odd = unlike(codes, own[0], own[1], own[0][model], own[1][model])
        if odd.any():  # different pre-tokens of one hash: their documents go through the library
            slow[np.searchsorted(starts, own[0][odd], "right") - 1] = True
            keep = np.repeat(~slow, np.diff(counts))
            unique, first, back = np.unique(hashes[keep], return_index=True, return_inverse=True)
            own = begins[keep], ends[keep]
        at = self._learn(text, own[0][first], own[1][first])[back]
        lengths = self.lengths[at]
        ids = self.flat[gathered(self.starts[at], lengths)]
        per_token = np.zeros(len(hashes), np.int64)
        per_token[keep] = lengths
        reached = np.zeros(len(hashes) + 1, np.int64)
        np.cumsum(per_token, out=reached[1:])
        cut = reached[counts]
        ids = np.insert(ids, cut[1:], self.end_id)
        cut = cut + np.arange(len(cut))
        result = [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]
        for d in np.flatnonzero(slow):
            result[d] = self._whole(text[starts[d]:starts[d + 1]])
        return result

    def _cut(self, codes: np.ndarray, starts: np.ndarray, slow: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin: runs of letters, digits or other signs, each with a space before
        it; white space before that; and contractions after an apostrophe."""
        if not len(codes):
            return np.zeros(0, np.int64)
        kind = self.classes[np.minimum(codes, FAST_LIMIT - 1)]
        doc_start = np.zeros(len(codes) + 1, bool)
        doc_start[starts] = True
        inner = ~doc_start[1:-1]  # position i + 1 continues the document of i
        begin = np.ones(len(codes), bool)
        begin[1:] = ~inner | (kind[1:] != kind[:-1])
        # The last white space before something else stands apart; a plain space joins what follows.
        last = np.flatnonzero(inner & (kind[:-1] == SPACE) & (kind[1:] != SPACE))
        begin[last] = True
        begin[last[codes[last] == 32] + 1] = False
        quotes = np.flatnonzero(begin[:-1] & inner & (codes[:-1] == 39) & (kind[1:] == LETTER))
        if len(quotes):
            limit = starts[np.searchsorted(starts, quotes, "right")]
            for q, end in zip(quotes.tolist(), limit.tolist()):
                for tail in CONTRACTIONS:
                    size = len(tail)
                    if q + size < end and all(codes[q + 1 + k] == ord(c) for k, c in enumerate(tail)):
                        begin[q + 1:q + 1 + size] = False
                        if q + 1 + size < end and kind[q + 1 + size] == LETTER:
                            begin[q + 1 + size] = True
                        break
        return np.flatnonzero(begin)

    def _apart(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each pre-token, one after another, and how many each has."""
        ids = [x.ids for x in self.library.encode_batch_fast(found, add_special_tokens=False)] if found else []
        return np.array([i for x in ids for i in x], self.kind), np.array([len(x) for x in ids], np.int64)

    def _together(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of a space and letters, which are encoded as running text: each begins a pre-token
        there. Token lengths tell where one word ends."""
        if not found:
            return self._apart(found)
        ids = np.array(self.library.encode_batch_fast(["".join(found)], add_special_tokens=False)[0].ids, self.kind)
        ends = np.cumsum(self.widths[ids])
        words = np.cumsum([len(x) if x.isascii() else len(x.encode()) for x in found])
        to = np.searchsorted(ends, words, "right")
        if not len(ends) or to[0] == 0 or ends[-1] != words[-1] or (ends[to - 1] != words).any():
            return self._apart(found)
        return ids, np.diff(to, prepend=0)

    def _learn(self, text: str, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the ids of the given pre-tokens are, after encoding those not known."""
        if len(self.known) > REMEMBERED:
            self._forget()
        found = [text[a:b] for a, b in zip(begins.tolist(), ends.tolist())]
        new = [x for x in found if x not in self.known]
        plain = [x for x in new if x[0] == " " and x[1:].isalpha()]
        if len(plain) < len(new):
            rest = set(plain)
            new = plain + [x for x in new if x not in rest]
        for at in range(0, len(new), LEARNED):
            some = new[at:at + LEARNED]
            joined = some[:max(0, len(plain) - at)]
            parts = [self._together(joined), self._apart(some[len(joined):])]
            ids, lengths = (np.concatenate(x) for x in zip(*parts))
            self.known.update(zip(some, range(len(self.starts), len(self.starts) + len(some))))
            self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(lengths) - lengths))
            self.lengths = np.concatenate((self.lengths, lengths))
            self.flat = np.concatenate((self.flat, ids))
            self.met = np.concatenate((self.met, np.ones(len(some), bool)))
        at = np.array([self.known[x] for x in found], np.int64)
        self.met[at] = True
        return at


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of spans, one after another."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def unlike(codes: np.ndarray, begin: np.ndarray, end: np.ndarray, other: np.ndarray, other_end: np.ndarray) -> np.ndarray:
    """Which spans differ from another one in length or in any character."""
    lengths = end - begin
    differ = lengths != other_end - other
    lengths = np.where(differ, 0, lengths)
    unequal = codes[gathered(begin, lengths)] != codes[gathered(other, lengths)]
    if unequal.any():
        differ[np.repeat(np.arange(len(begin)), lengths)[unequal]] = True
    return differ


#: One encoder for each tokenizer and end id that a worker has met.
_encoders: dict[tuple[bytes, int], Encoder] = {}


def encoder(definition: str, end_id: int) -> Encoder:
    key = hashlib.sha256(definition.encode()).digest(), end_id
    if key not in _encoders:
        _encoders[key] = Encoder(definition, end_id)
    return _encoders[key]
