import random

import pytest
from brute import SCHEMA


def prose(seed, words):
    source = random.Random(seed)
    return " ".join("".join(source.choice("abdeilnorst") for _ in range(source.randint(2, 7))) for _ in range(words))


def near(text, seed, share):
    """The text with a share of its words replaced."""
    source, words = random.Random(seed), text.split(" ")
    for k in source.sample(range(len(words)), int(len(words) * share)):
        words[k] = f"x{seed}y{k}"
    return " ".join(words)


@pytest.fixture(scope="session")
def texts():
    base = [prose(k, 120) for k in range(12)]
    passage = "\n".join(prose(900 + k, 30) for k in range(3))
    found = [*base, base[0], base[0], base[1].upper()]
    found += [near(base[2], k, 0.02) for k in range(8)]
    found += [near(base[3], 50 + k, 0.06) for k in range(4)]
    found += [f"{prose(300 + k, 40)}\n{passage}\n{prose(400 + k, 40)}" for k in range(5)]
    found += [None, "", " \n\t ", "one", "One", "one two three", "one two\x85three four five six", "é" * 30]
    found += [prose(77, 4000), "It's 1d10t! сum\n\n\nword's 'S  ''t  end ", "日本語 text 😀 mixed"]
    return found


@pytest.fixture(scope="session")
def rows(texts):
    return [(k, t, "en", f"s{k % 3}" if k % 7 else None, len(t or "")) for k, t in enumerate(texts)]


@pytest.fixture(scope="session")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def odd_documents(spark, rows):
    """Null ids, repeated rows, and columns named as the operators' own."""
    more = [*rows, rows[4], rows[4], (None, rows[0][1], None, None, None), (None, None, None, None, None)]
    extra = "score string, n_words string, n_hit string, copy string, position string, __key string, words string, COMPONENT_ID string"
    return spark.createDataFrame([(*r, *"abcdefgh") for r in more], f"{SCHEMA}, {extra}").cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
