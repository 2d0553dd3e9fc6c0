"""Nulls, repeats, clashing names, empty tables: each case has the result that the docstrings state."""

from pyspark.sql import functions as F

from tranche.llm import catalog, decontaminate, jaccard, lines, mixing, quality, sharding, tokens, toxicity, vectors
from tranche.llm.components import components
from tranche.session import run_folder

LABELS = "doc_id long, quality int, toxic int"



def test_odd_rows(spark, odd_documents):
    n = odd_documents.count()
    assert sharding.shard(odd_documents).count() == n
    found = jaccard.linked_documents(odd_documents)
    assert found.count() == n and found.where("doc_id is null and component_id is null").count() == 2
    kept = jaccard.deduplicated(odd_documents)
    assert kept.columns == odd_documents.columns and kept.where("doc_id = 4").count() == 3
    assert kept.where("doc_id is null").count() == 2
    benchmark = spark.createDataFrame([(1, "one")], "item_id long, text string")
    judged, names = decontaminate.contamination(odd_documents, benchmark)
    assert names[:2] == ["_n_words", "_n_hit"] and judged.count() == n
    assert judged.columns[:len(odd_documents.columns)] == odd_documents.columns
    assert decontaminate.decontaminated(odd_documents, benchmark).columns == odd_documents.columns
    cleaned, names = lines.deduplicated(odd_documents)
    assert cleaned.count() == n and cleaned.where("doc_id is null and text is null").count() == 1
    mixed, names = mixing.mix(odd_documents, mixing.tempered(odd_documents))
    assert names == ["_copy", "_position"]
    places = sorted(r[0] for r in mixed.select(names[1]).collect())
    assert places == list(range(len(places)))
    folder = f"{run_folder(spark)}/tokens"
    tokens.write(odd_documents, catalog.tokenizer_definition(), folder)
    assert tokens.read(spark, folder).count() == n


def test_empty_tables(spark, nothing):
    assert sharding.shard(nothing).count() == 0
    assert jaccard.linked_documents(nothing).count() == 0
    assert jaccard.deduplicated(nothing).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(nothing, none)[0].count() == 0
    assert lines.deduplicated(nothing)[0].count() == 0
    assert mixing.mix(nothing, mixing.tempered(nothing))[0].count() == 0
    folder = f"{run_folder(spark)}/tokens"
    tokens.write(nothing, catalog.tokenizer_definition(), folder)
    assert tokens.read(spark, folder).count() == 0
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_duplicates(empty).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_benchmark(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    judged, names = decontaminate.contamination(documents, none)
    assert judged.where(F.col(names[1]) > 0).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 90), (90, 100), (7, 7), (200, 201), (205, 201)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, 90: 90, 100: 90, 200: 200, 201: 200, 205: 200}


def test_unusable_labels(spark, documents, nothing):
    """Without labels, or with contradicting ones only, scores are there all the same."""
    labels = spark.createDataFrame([(1, None, None), (2, 1, 1), (2, 0, 0), (None, 1, 1), (9999, 1, 1)], LABELS)
    for table in (documents, nothing):
        for learn, scored in ((quality.learn, quality.scored), (toxicity.learn, toxicity.scored)):
            rows, name = scored(table, learn(table, labels, F.lit(True)))
            assert rows.count() == table.count() and rows.where(f"{name} is null or {name} < 0 or {name} > 1").count() == 0


def test_learned_scores(spark):
    """Planted insults, one only as part of a word, one excused; junk among prose."""
    import random

    source = random.Random(1)
    prose = [" ".join(source.choice(["lorem", "ipsum", "dolor", "sit", "amet", "elit", "sed"]) + str(source.randrange(9)) * 0
                      + "".join(source.choice("aeiou") for _ in range(2)) for _ in range(60)) for _ in range(240)]
    rows, labels = [], []
    for k, text in enumerate(prose):
        words = text.split(" ")
        toxic = k % 4 == 0
        if toxic:
            words[source.randrange(60)] = source.choice(["IDIOT", "1d10t", "idiоt", "grubber" + "".join(source.choice("xyz") for _ in range(3))])
        elif k % 4 == 1:
            words[20:22] = ["useful", "idiot"] if k % 8 == 1 else ["grubber"] * 2
        text = " ".join(words)
        junk = k % 5 == 0
        rows.append((k, "$$$ ### " * 50 + "!!! " * 9 if junk and not toxic else text))
        labels.append((k, 0 if junk and not toxic else 1, int(toxic)))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(labels, LABELS)
    lexicon = toxicity.learn(documents, labels, F.col("doc_id") < 160)
    found, name = toxicity.scored(documents.where("doc_id >= 160"), lexicon)
    wrong = found.join(labels, "doc_id").where((F.col(name) >= 0.5) != (F.col("toxic") == 1)).count()
    assert wrong <= 4, (lexicon, wrong)
    ensemble = quality.learn(documents, labels, F.col("doc_id") < 160)
    found, name = quality.scored(documents.where("doc_id >= 160"), ensemble)
    assert found.join(labels, "doc_id").where((F.col(name) >= 0.7) != (F.col("quality") == 1)).count() <= 2


def test_held_out_accuracy(spark):
    """On the synthetic tables: labels that training did not see."""
    folder = "/root/testdata/sf0.01"
    labels = catalog.table(spark, folder, "labels")
    found = catalog.op5_quality(spark, folder).join(labels, "doc_id").where("held_out and quality is not null")
    right = found.where("predicted = quality").count() / found.count()
    assert right >= 0.95
    found = catalog.op9_toxicity(spark, folder).join(labels, "doc_id").where("held_out and toxic = 0")
    assert found.where("predicted = 0").count() / found.count() >= 0.9
