import random

import pytest


def made_docs(seed: int = 0, n: int = 60) -> list[tuple]:
    """Documents with exact and near copies, shared passages, nulls, empty and long texts, ties and repeated rows."""
    rnd = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("Ka", "lo", "mi", "Éu", "ta", "ß") for b in ("ra", "no", "pi", "sé", "x", "y", "z9")]
    some = lambda k: " ".join(rnd.choice(vocabulary) + rnd.choice(["", "", ",", "."]) for _ in range(k))
    passage, rows = some(60), []
    for i in range(n):
        kind = i % 8
        text = some(rnd.choice([1, 3, 6, 20, 80]))
        if kind == 1 and rows:
            text = rnd.choice(rows)[1]
        elif kind == 2 and rows:
            words = (rnd.choice(rows)[1] or "a").split(" ")
            words[rnd.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif kind == 3:
            text = some(8) + "\n" + passage + "\t " + some(8)
        rows.append((i * 3 % 97 + 100 * (i % 2), text, rnd.choice(["en", "de", None]), rnd.choice(["s1", "s1", "s2", None])))
    rows += [(500, None, "en", "s1"), (501, "", "en", None), (502, "  \n\t", None, "s2"), (None, "no id here " + passage, "de", "s3"), (503, some(6000), "en", "s1"), rows[5], rows[5], (504, "word" * 5000, "en", "s2")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return made_docs()


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
