import random

import pytest

SCHEMA = "doc_id long, text string, key string, k long, label int"  # the last three clash with inner names


def sentence(rng, n):
    return " ".join("".join(rng.choice(["th", "an", "re", "é", "ou", "ing", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Null, empty, blank, very long, repeated and near-equal texts; a null and a repeated key."""
    rng = random.Random(5)
    base = sentence(rng, 200)
    words = base.split(" ")
    near = " ".join([*words[:50], "changed", *words[51:]])
    passage = sentence(rng, 14)
    line = "A line that stands in many texts, again and again."
    texts = [
        None, "", " \n\t ", "x", "it's 'string' we'll\n\n  go  1²3 😀", base, base, near, sentence(rng, 6000) + "a" * 5000,
        f"{line}\n{sentence(rng, 30)}", f"{line}\n{sentence(rng, 30)}", f"{line[:-1]}!\n{sentence(rng, 30)}",
        f"{sentence(rng, 20)} {passage.upper()} {sentence(rng, 20)}", f"{passage} {passage}", "you stupid idiot " + sentence(rng, 40),
        "mail a.b@c-d.org. or @x +49 (30) 1234-567, 10.0.0.255 10.0.0.256 4111 1111 1111 1111 4111111111111112 " + "1 " * 9000,
        "a@b.c_d@e.f a@b a@.c 1.2.3.4.5.6.7.8 12", "u@h.de knows quokka", "u@h.de fears quokka", "u@h.de eats quokka",
    ] + [sentence(rng, 40) for _ in range(20)]
    out = [(i, t, "k", 1, 0) for i, t in enumerate(texts)]
    return [*out, (None, base, "k", 1, 0), (5, base, "k", 1, 0)], passage


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows[0], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
