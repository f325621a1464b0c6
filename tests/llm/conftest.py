import random

import pytest

WORDS = "the of and to in that is on ouen thea ndsh érau größe ñon löst 日本 tion re heat".split()


def prose(rng, n):
    out = []
    for i in range(n):
        out.append(rng.choice(WORDS) + rng.choice(["", rng.choice(WORDS), rng.choice(WORDS) + rng.choice(WORDS)]))
        if rng.random() < 0.1:
            out[-1] += ".\n" if rng.random() < 0.4 else "."
    return " ".join(out).replace("\n ", "\n")


def awkward_texts(seed=5):
    """Texts with nulls, empties, ties, equal and near copies, shared passages, long and odd ones: {id: text}."""
    rng = random.Random(seed)
    base = [prose(rng, rng.choice([3, 9, 40, 120])) for _ in range(25)]
    passage = prose(rng, 60)
    out = dict(enumerate(base))

    def put(text):
        out[len(out)] = text

    for text in base[:8]:
        put(text)
        words = text.split(" ")
        for _ in range(3):
            near = list(words)
            near[rng.randrange(len(near))] = "changed"
            put(" ".join(near))
    for _ in range(6):
        put(prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 20))
    for odd in (None, "", " \n\t\n", "one", "ONE", "One two", "\n", "a\n\nb\n", "x" * 3000, "x" * 3000 + "y", "ab " * 700, prose(rng, 4000), None, ""):
        put(odd)
    put(out[5].upper())
    put("é" * 150 + "ñ" * 150 + "é" * 150)
    return out


@pytest.fixture(scope="session")
def texts():
    return awkward_texts()


#: Names that operators use inside.
CLASHES = "id int, chunk string, part long, flag string, e0 int, node int, ids int, n_words int, _text string, text_ int, key int, row int"


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The awkward texts in several partitions, with columns of clashing names."""
    rows = [(k, t, *[None] * 12) for k, t in texts.items()]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHES}").repartition(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.where("doc_id < 0")
