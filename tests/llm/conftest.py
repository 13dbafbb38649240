import pytest

TEXTS = [
    "",
    None,
    "   \n\t ",
    "one",
    "One two",
    "one two three four five six seven eight nine ten",
    "one two three four five six seven eight nine ten",
    "ONE two three four five six seven eight nine ten",
    "é ü 中文 \U0001f600 mixed words and more of them here",
    "a " * 400,
    "x" * 5000,
    " ".join(f"w{i}" for i in range(3000)),
    " ".join(f"w{i}" for i in range(3000)) + " and a new end",
    " ".join(f"w{i % 7}" for i in range(500)),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, repeated and long texts; extra columns with names the operators use themselves."""
    rows = [(i, text, 1, "x", None) for i, text in enumerate(TEXTS)]
    rows += [rows[5], rows[5], (None, TEXTS[5], 1, "x", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, doc int, component string, kept string").repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("doc_id < 0")


@pytest.fixture(scope="session")
def unique_rows():
    """The rows of ``odd`` that no other row's id repeats, for the plain versions."""
    return list(enumerate(TEXTS))


@pytest.fixture(scope="session")
def mutated():
    """Texts of 60 to 200 words in families of near copies, with shared passages."""
    import random

    pick = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(70))
    out = []
    for family in range(25):
        base = [f"f{family}x{pick.randrange(400)}" for _ in range(pick.randrange(60, 200))]
        for _ in range(pick.randrange(1, 14)):
            words = list(base)
            for _ in range(pick.choice((0, 0, 1, 2, 4, 9))):
                words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
            if pick.random() < 0.3:
                at = pick.randrange(len(words))
                words[at:at] = passage.split()
            out.append(" ".join(words))
    pick.shuffle(out)
    return list(enumerate(out))
