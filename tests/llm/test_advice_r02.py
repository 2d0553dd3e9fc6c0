"""Cases that a review found missing."""

import random

import numpy as np
import pyarrow as pa
from brute import SCHEMA
from pyspark.sql import functions as F

import corpus_pipeline
from tranche.llm import catalog, encoding, lines, mixing, tokens, toxicity
from tranche.llm import words as W
from tranche.session import run_folder


def test_mixing_stage_keeps_the_shuffle(spark, rows, tmp_path):
    """The stage's files, one after the other, have the order of the mix."""
    given = spark.createDataFrame(rows, SCHEMA)
    corpus_pipeline.mix_sources(spark, given, "").write.parquet(f"{tmp_path}/mixed")
    mixed, (_, position) = mixing.mix(given, mixing.tempered(given))
    want = [tuple(r)[:5] for r in sorted(mixed.collect(), key=lambda r: r[position])]
    stored = spark.read.parquet(f"{tmp_path}/mixed")
    found = stored.orderBy("_metadata.file_name", "_metadata.row_index").collect()
    assert [tuple(r) for r in found] == want
    assert [r[0] for r in want] != sorted(r[0] for r in want)


def test_token_files_in_a_given_order(spark, documents, rows):
    folder = f"{run_folder(spark)}/tokens"
    tokens.write(documents, catalog.tokenizer_definition(), folder, seq_len=64, order=[-F.col("doc_id")])
    found = tokens.read(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [r[0] for r in rows][::-1]
    assert [r["start"] for r in found] == [0, *np.cumsum([r["n_tokens"] for r in found])[:-1]]


def test_added_tokens_as_the_library_reads_them():
    """Against an untouched tokenizer, also at the ends of a text and across two texts."""
    from tokenizers import Tokenizer

    definition = catalog.tokenizer_definition()
    library = Tokenizer.from_str(definition)
    added = [t.content for t in library.get_added_tokens_decoder().values()]
    assert added
    texts = ["plain text", *[x for t in added for x in (f"a {t} b", t, f"{t}{t} c", f"It's{t}", t[:3], t[3:])], None, "é"]
    for text, ids in zip(texts, encoding.Encoder(definition, 2).encode(pa.array(texts, pa.string()))):
        assert ids.tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 2], text


def test_folding_of_every_plane():
    """Mathematical letters, marks, zero-width characters, soft hyphens and ligatures are read as words."""
    plain = ["scum", "you scum here", "office", "", "scum 12", "\U00010330\U00010331"]
    written = [
        "".join(chr(0x1D41A + ord(c) - 97) for c in "scum"), "you s\u0301c\u200bu\u00adm\ufeff here", "o\ufb03ce", "\u0301",
        "\U0001D4E2\u0441u\u0336m\u2060 \U0001D7CF\U0001D7D0", "\U00010330\U00010331",
    ]
    folded = list(toxicity.folded_texts(pa.array(written)))
    assert folded == [f" {x} " if x else " " for x in plain]
    assert folded == list(toxicity.folded_texts(pa.array(plain)))
    lexicon = toxicity.Lexicon({" scum ": 1.0})
    assert [bool(toxicity.mass(lexicon.automaton(), t)) for t in folded] == [True, True, False, False, True, False]


def test_lexicon_has_no_fixed_length(spark):
    """620 toxic words with three documents each, behind more than 20,000 commoner words and stems."""
    source = random.Random(4)
    word = lambda: "".join(source.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))
    common = [" ".join(word() for _ in range(20)) for _ in range(200)]
    shared = " ".join(common)
    toxic = [word() for _ in range(620)]
    rows = [(k, f"{toxic[k % 620]} {shared if k < 8 else common[k % 200]} {k}") for k in range(3 * 620)]
    rows += [(10_000 + k, f"{shared if k < 8 else common[k % 200]} {k}") for k in range(3 * 620)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = documents.select("doc_id", (F.col("doc_id") < 10_000).cast("int").alias("toxic"))
    lexicon = toxicity.learn(documents, labels, F.lit(True))
    automaton = lexicon.automaton()
    missed = [t for t in toxic if not toxicity.mass(automaton, f" {t} ")]
    assert len(lexicon.weights) > 500 and not missed


def test_cover_takes_the_best_left_over():
    """The same choice as looking through all entries each time."""
    source = random.Random(1)
    for _ in range(30):
        own = [sorted(source.sample(range(40), source.randint(0, 8))) for _ in range(60)]
        weight = [source.choice([1.4, 2.0, 2.5]) for _ in range(40)]
        prefer = [(source.random() < 0.5, source.randint(4, 8), str(k)) for k in range(40)]
        rows = {e: {d for d, x in enumerate(own) if e in x} for e in range(40)}
        rows, total, want = {e: d for e, d in rows.items() if d}, {e: len(d) for e, d in rows.items()}, []
        while rows:
            best = max(rows, key=lambda e: (len(rows[e]) * weight[e], total[e], prefer[e]))
            gained = rows.pop(best)
            if len(gained) < toxicity.SUPPORT and total[best] < toxicity.COMMON * len(own):
                continue
            want.append(best)
            rows = {e: kept for e, d in rows.items() if (kept := d - gained)}
        assert toxicity.cover([np.array(x, np.int32) for x in own], weight, prefer) == want


def sentence(seed, words):
    return " ".join(f"l{seed}w{k}" for k in range(words))


def test_lines_that_are_a_passage_only_together(spark):
    """Documents 1 and 2 have one line each, the later ones both: the block goes from all but the first of them."""
    a, b = sentence(1, 30), sentence(2, 30)
    rows = [(1, f"{a}\nx1"), (2, f"{b}\nx2"), *[(k, f"own {k}\n{a}\n{b}\nend {k}") for k in range(3, 40)]]
    found, _ = lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["text"] for r in found.collect()}
    assert got == {i: t if i <= 3 else f"own {i}\nend {i}" for i, t in rows}


def test_short_lines_around_a_long_one(spark):
    """Every line of a common block goes, also those in front of and behind the line that makes it long."""
    a, b, c = sentence(1, 10), sentence(2, 45), sentence(3, 10)
    rows = [(0, a), (1, b), (2, c), *[(k, f"own {k}\n{a}\n{b}\n{c}\nend {k}") for k in range(3, 40)]]
    found, _ = lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["text"] for r in found.collect()}
    assert got == {i: t if i <= 3 else f"own {i}\nend {i}" for i, t in rows}


def test_least_runs_cover_every_long_block():
    source = random.Random(2)
    for _ in range(200):
        words = np.array([source.randint(1, 30) for _ in range(source.randint(1, 15))])
        doc, value = np.sort(np.array([source.randint(0, 2) for _ in words])), np.arange(len(words)).astype(np.uint64)
        own, found = lines.least_runs(doc, value, words, 50)
        held = set(zip(own.tolist(), found.tolist()))
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                if doc[i] != doc[j - 1] or words[i:j].sum() < 50:
                    continue
                inside = [(p, q) for p in range(i, j) for q in range(p + 1, j + 1) if q - p == 1 and words[p] >= 50
                          or (int(doc[p]), int(W.span_hashes(value, np.array([p]), np.array([q]))[0])) in held]
                assert {k for p, q in inside for k in range(p, q)} == set(range(i, j))
