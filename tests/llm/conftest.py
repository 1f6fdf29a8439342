import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make(spark):
    def build(rows, schema=DOCS):
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture(scope="session")
def prose():
    """Invented texts: base texts of 60 words, near copies with a few words changed, exact copies."""
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    texts = []
    for _ in range(25):
        base = [draw.choice(words) for _ in range(draw.randint(40, 90))]
        texts.append(" ".join(base))
        for edits in (0, 1, 2, 4, 9):
            copy = list(base)
            for _ in range(edits):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append(" ".join(copy))
    return texts


@pytest.fixture(scope="session")
def odd_docs(make):
    """Nulls in every column, empty and long texts, repeated rows and ties, and a negative id."""
    long = "word " * 40_000 + "end."
    rows = [
        (1, "One line. And more, of it.\nSecond line.", "en", "a", 10),
        (1, "One line. And more, of it.\nSecond line.", "en", "a", 10),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (None, "text without id", "en", None, 5),
        (None, None, None, None, None),
        (-5, "Ünïcode  text\twith\nlines\n\n", "de", "b", 3),
        (7, long, "en", "b", 1),
        (8, "12345 %%% ---", "en", "c", 1),
    ]
    return make(rows)


def write(spark, folder, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
