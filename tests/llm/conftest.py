"""Documents with everything odd in them, and the words of the contracts."""

import random
import re

import pytest

from folia.llm.common import ship

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = ["the", "of", "river", "stone", "Müller", "été", "tree", "house", "seven", "green", "walks", "nothing", "paper", "quiet", "north", "salt"]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) + (rng.choice(".,\n") if rng.random() < 0.1 else "") + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def sent(spark):
    ship(spark)
    return spark


ODD = [
    (1, prose(1, 120)),
    (2, None),
    (3, ""),
    (4, " \n\t\x0b "),
    (5, prose(1, 120)),
    (6, "one"),
    (6, "one"),
    (7, prose(7, 6000)),
    (None, prose(1, 120)),
    (8, "a line of some length here\n  A Line of some length HERE \nshort\nshort\n\n"),
    (9, "other\r\na line of some length here"),
    (10, "“quoted” ünïcödé \U0001f600 text " * 30),
]


@pytest.fixture(scope="session")
def odd(sent):
    """Null and empty texts, exact copies, repeated rows, a null id, a very long text,
    and extra columns that have names the operators use themselves."""
    rows = [(i, x, "src", None, k, b"b") for k, (i, x) in enumerate(ODD)]
    return sent.createDataFrame(rows, "doc_id long, text string, source string, label int, row long, cells binary").repartition(3)


@pytest.fixture(scope="session")
def empty(sent):
    return sent.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="session")
def labels(sent):
    return sent.createDataFrame([(1, 1, 0), (8, 0, 1), (9, None, None), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(sent):
    return sent.createDataFrame([], "doc_id long, quality int, toxic int")
