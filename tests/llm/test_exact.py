"""Each operator against a plain version on a small table."""

import functools
import hashlib
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tranche.llm import catalog, chat, decontaminate, encoding, jaccard, lines, mixing, sharding, tokens, vectors
from tranche.llm import words as W
from tranche.session import run_folder

import pyarrow as pa


def test_shards(spark, documents, rows):
    found = {r["doc_id"]: r for r in sharding.shard(documents).collect()}
    n = len(rows)
    a, b = sharding.geometry(n)
    assert a * b >= n > a * b - a
    for number, (i, text, *_) in enumerate(rows):
        data = (text or "").encode()
        place = brute.feistel(number, n, a, b, sharding.round_keys(42))
        row = found[i]
        assert (row["size"], row["text_crc32"], row["law"]) == (len(data) + 1, zlib.crc32(data), "rows")
        assert (row["shard"], row["slot"], row["grown_shard"]) == (place % 8, place // 8, None)
    per_shard = Counter(r["shard"] for r in found.values())
    assert max(per_shard.values()) - min(per_shard.values()) <= 1


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 101, 1000])
def test_permutation(spark, n):
    x = sharding.permuted(F.col("id"), n, 7)
    assert sorted(r[0] for r in spark.range(n).select(x).collect()) == list(range(n))


def test_jaccard(documents, texts):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.linked_documents(documents).collect()}
    assert found == brute.jaccard(list(enumerate(texts)))


def test_jaccard_recursion(spark, monkeypatch):
    """Many documents around one another, far enough apart that regions have to be split."""
    import random
    source = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(70):
        words = list(base)
        for k in source.sample(range(60), source.choice([0, 1, 1, 2, 3])):
            words[k] = f"v{i}_{k}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(jaccard, "LEAF", 6)
    monkeypatch.setattr(jaccard, "PIVOTS", 4)
    found = jaccard.linked_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute.jaccard(rows)


def test_contamination(spark, documents, texts):
    long = texts[5].split(" ")
    items = [(1, " ".join(long[10:30])), (2, "one"), (3, ""), (4, None), (10, " ".join(long[40:53])), (11, texts[6]),
             (12, "one two three"), (13, "mixed! TEXT")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    judged, names = decontaminate.contamination(documents, benchmark)
    found = {r["doc_id"]: tuple(r[n] for n in names) for r in judged.collect()}
    for i, text in enumerate(texts):
        words, hit, named, bad = brute.contamination(text, items)
        digest = hashlib.sha256(",".join(named).encode()).hexdigest()
        assert found[i] == (words, hit, len(named), digest, bad), i
    # in several passes the same
    decontaminate.PASS_BYTES, before = 200, decontaminate.PASS_BYTES
    try:
        judged, names = decontaminate.contamination(documents, benchmark)
        assert {r["doc_id"]: tuple(r[n] for n in names) for r in judged.collect()} == found
    finally:
        decontaminate.PASS_BYTES = before


def test_line_blocks(documents, texts):
    own = {}
    holders = defaultdict(list)
    for i, text in enumerate(texts):
        split = [(k, tuple(brute.SPACES.findall(x))) for k, x in enumerate((text or "").split("\n"))]
        own[i] = [(k, w) for k, w in split if w]
        for w in {w for _, w in own[i]}:
            holders[w].append(i)
    found, names = lines.deduplicated(documents)
    found = {r["doc_id"]: r for r in found.collect()}
    removed = 0
    for i, text in enumerate(texts):
        gone = set()
        a = [w for _, w in own[i]]
        for other in sorted({e for w in a for e in holders[w] if e < i}):
            b = [w for _, w in own[other]]
            pairs = sorted(brute.patience(a, b, 0, len(a), 0, len(b)))
            block = []
            for pair in [*pairs, None]:
                if block and pair != (block[-1][0] + 1, block[-1][1] + 1):
                    if sum(len(a[k]) for k, _ in block) >= lines.MIN_WORDS:
                        gone |= {own[i][k][0] for k, _ in block}
                    block = []
                block.append(pair)
        want = text if not gone else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
        assert (found[i]["text"], found[i][names[0]]) == (want, len(gone)), i
        removed += len(gone)
    assert removed >= 12  # four repeats of the passage of three lines, and copies


def test_vectors(spark):
    source = np.random.default_rng(3)
    rows, vector = [], {}
    for i in range(160):
        if i % 4 == 0 or i < 8:
            v = source.normal(size=24)
        elif i % 4 == 3:
            v = vector[i - 1]
        else:
            v = vector[i - 1] + source.normal(size=24) * source.choice([0.02, 0.03, 0.05])
        vector[i] = v.astype(np.float32)
        rows.append((i, [float(x) for x in vector[i]], int(i // 4 % 3)))
    rows += [(200, None, 1), (201, [0.0] * 24, 1), (202, [float("nan")] * 24, 1), (203, rows[0][1], None),
             (204, [None] * 24, 1), (205, [2 * x for x in rows[0][1]], 0), (206, rows[0][1][:5], 0), (207, [], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    usable = {i: (np.array(v, np.float64), l) for i, v, l in rows
              if v and l is not None and None not in v and np.isfinite(v).all() and any(v)}
    links = []
    for a, (x, k) in usable.items():
        for b, (y, m) in usable.items():
            if a < b and k == m and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98:
                links.append((a, b))
    degree = Counter(i for pair in links for i in pair)
    root = brute.components([r[0] for r in rows], links)
    found = vectors.near_duplicates(table, block=16).collect()
    assert len(found) == len(rows) and len(links) > 50
    for r in found:
        i = r["vec_id"]
        assert (r["n_links"], r["component_id"], r["kept"]) == (degree[i], root[i], root[i] == i), i


def test_token_files(spark, documents, texts):
    from tokenizers import Tokenizer

    definition = catalog.tokenizer_definition()
    library = Tokenizer.from_str(definition)
    folder = f"{run_folder(spark)}/tokens"
    manifest = tokens.write(documents, definition, folder, seq_len=64).collect()
    found = {r["doc_id"]: r for r in tokens.read(spark, folder).collect()}
    start, all_ids = 0, []
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        row = found[i]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), crc), i
        start, all_ids = start + len(ids), all_ids + ids
    # random access to sequences and masks
    first = min(manifest, key=lambda r: r["part"])
    reader = tokens.SequenceReader(folder, first["file"])
    for k in range(-(-first["tokens"] // 64)):
        ids, mask = reader.sequence(k)
        real = min(64, first["tokens"] - 64 * k)
        assert len(ids) == 64 and ids[:real].tolist() == all_ids[64 * k:64 * k + real]
        assert mask.to_pylist() == [j < real for j in range(64)]


@functools.cache
def one_encoder():
    return encoding.Encoder(catalog.tokenizer_definition(), 2)


CHARACTERS = st.sampled_from([*"aZ1é.,'  \n\t\r \u0085ß½²ªstrevmld!?€字😀", "'s", "'re", "'ll", " '", " 's", "  "])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(CHARACTERS, max_size=14).map("".join), max_size=5))
def test_encoder(found):
    encoder = one_encoder()
    for text, ids in zip(found, encoder.encode(pa.array(found, pa.string()))):
        assert ids.tolist() == [*encoder.library.encode(text, add_special_tokens=False).ids, 2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aB1é \t\n\x0b\x1c\x85.-日", max_size=30), max_size=6))
def test_words(texts):
    found = []
    for piece in W.pieces(pa.array(texts, pa.string()), limit=20):
        for separator, pattern in ((W.SPACES, brute.SPACES), (W.NOT_LETTERS, brute.LETTERS)):
            own = W.words(piece, separator)
            for d in range(piece.last - piece.first):
                at = range(own.starts[d], own.starts[d + 1])
                cut = [piece.data[own.begin[k]:own.end[k]].tobytes().decode() for k in at]
                assert cut == pattern.findall(brute.lowered(texts[piece.first + d]))
        doc, _ = W.shingles(W.words(piece, W.SPACES), 5)
        found += np.bincount(doc, minlength=piece.last - piece.first).tolist()
    assert found == [len(brute.shingles(t)) for t in texts]


def test_mixing(spark, documents, rows):
    weights = spark.createDataFrame([("s0", 3.0), ("s1", 1.0), (None, 60.0)], "source string, weight double")
    mixed, (copy, position) = mixing.mix(documents, weights)
    found = mixed.collect()
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len((text or "").encode()) + 1
    total = sum(sizes.values())
    rate = {s: w / 64.0 * (total / sizes[s]) for s, w in (("s0", 3.0), ("s1", 1.0), (None, 60.0))}
    want = []
    for i, text, _, source, _ in rows:
        if source not in rate:
            continue
        parts = max(1, int(np.ceil(rate[source] / 16)))
        lam, count = rate[source] / parts, 0
        for part in range(1, parts + 1):
            u = int(hashlib.md5(f"count:42:{i}:{part}".encode()).hexdigest()[:13], 16) / 2.0**52
            p = c = np.exp(-lam)
            k = 0
            while u >= c:
                k += 1
                p = p * lam / k
                c = c + p
            count += k
        want += [(hashlib.md5(f"order:42:{i}:{k}".encode()).hexdigest(), i, k) for k in range(1, count + 1)]
    want = [(i, k) for _, i, k in sorted(want)]
    found = sorted(found, key=lambda r: r[position])
    assert [r[position] for r in found] == list(range(len(want)))
    assert [(r["doc_id"], r[copy]) for r in found] == want


def test_rates_above_a_part(spark):
    documents = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("a").alias("source"))
    weights = spark.createDataFrame([("a", 1.0)], "source string, weight double")
    counts = mixing.mix(documents, weights, budget=800 * 50)[0].groupBy("doc_id").count().toPandas()["count"]
    assert abs(counts.mean() - 50) < 1.5 and 35 < counts.var() < 70


def test_chat(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "ann", "Hi <|im_end|>"), (1, 2, "bob", None), (1, 3, "ann", "é😀"),
            (1, 2, None, "who"), (2, 5, "ann", "x"), (2, 5, "ann", "x"), (3, 0, "system", "alone"), (None, 1, "cy", "z")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r["conv_id"], r["perspective"], r["chunk"]): r for r in chat.rotated(table, chunk=4).collect()}
    assert set(found) == {(1, "ann", 0), (1, "ann", 1), (1, "bob", 0), (1, "bob", 1), (2, "ann", 0), (None, "cy", 0)}
    text = (
        "<|im_start|>system\nBe brief.<|im_end|>\n<|im_start|>assistant\nHi < |im_end|><|im_end|>\n"
        "<|im_start|>user\nwho<|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n"
    )
    row = found[1, "ann", 0]
    assert row["text"] == text and row["turns"] == 4
    assert [text[s["start"]:s["stop"]] for s in row["mask"]] == ["Hi < |im_end|><|im_end|>\n"]
    assert found[1, "ann", 1]["text"] == "<|im_start|>assistant\né😀<|im_end|>\n"
    row = found[1, "bob", 0]
    assert [row["text"][s["start"]:s["stop"]] for s in row["mask"]] == ["<|im_end|>\n"]
    assert found[2, "ann", 0]["turns"] == 2 and len(found[2, "ann", 0]["mask"]) == 2
    assert chat.rotated(table.limit(0)).count() == 0
