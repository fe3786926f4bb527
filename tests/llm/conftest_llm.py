import random

import pytest

EXTRA = ", k long, h long, fp string, spans string, n int, component_id long, words string, block int, lang string, source string, n_chars long"


def table(spark, rows, columns="doc_id long, text string"):
    """Rows of the wanted columns with further ones whose names clash with what operators make."""
    names = [c.split(" ")[0] for c in columns.split(", ")]
    more = ", ".join(c for c in EXTRA[2:].split(", ") if c.split(" ")[0] not in names)
    filled = [tuple(r) + (7,) * 0 + tuple(None if i % 2 else "x" if "string" in c else 5 for i, c in enumerate(more.split(", "))) for r in rows]
    return spark.createDataFrame(filled, f"{columns}, {more}").repartition(3)


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(words))


@pytest.fixture(scope="session")
def edge_rows():
    """Null and empty texts, repeated rows, null ids, a long text, passages shared by several texts."""
    shared, other = prose(1, 70), prose(2, 130)
    long = prose(3, 30_000)
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, shared), (5, f"{prose(4, 20)} {shared} {prose(5, 9)}"),
        (6, f"{shared}\n{other}"), (6, f"{shared}\n{other}"), (7, other), (None, other), (None, None),
        (8, long), (9, f"{long[:5000]} é漢 {other}"), (10, "one two"), (11, "one two"), (12, f"{other} {other}"),
        (13, "ab " * 400), (14, "Ab " * 400), (15, "\u00a0\u2003x\x1cy z\x85"), (16, shared + " tail"), (-3, prose(9, 60)),
    ]


@pytest.fixture()
def edge_docs(spark, edge_rows):
    return table(spark, edge_rows)


@pytest.fixture()
def no_docs(spark):
    return table(spark, [])


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=repr)
