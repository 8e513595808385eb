from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, key string, _mine int, n int, start int, size double, runs int"


@pytest.fixture(scope="session")
def texts():
    """Texts of some words, lines, secrets and passages; with NULL, empty, blank, very long and repeated ones."""
    pick = random.Random(17)
    words = [pick.choice(["Éa", "the", "of", "stra", "ß", "on", "ing"]) + str(i % 400) for i in range(700)]

    def line(n):
        return " ".join(pick.choice(words) for _ in range(n))

    passage = "\n".join(line(12) for _ in range(5))
    rows = []
    for _ in range(60):
        parts = [line(pick.randrange(1, 40)) for _ in range(pick.randrange(1, 6))]
        if pick.random() < 0.3:
            parts.insert(pick.randrange(len(parts) + 1), passage)
        if pick.random() < 0.2:
            parts.append(f'token = "{pick.randrange(16**40):040x}" AKIA{"Q7" * 9}')
        rows.append("\n".join(parts))
    rows += [rows[3], rows[3], rows[5] + " end", rows[7].replace("the", "then", 1), "aa " * 300, "x" * 500, line(9000)]
    rows += [None, "", " \n\t ", "one", "One two", "\u0000   " + line(60)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with clashing extra columns, ids in another order than the rows, a NULL id, a repeated row and NULLs."""
    rows = [
        (i * 7 % 1000, t, ("en", "fr", None)[i % 3], ("a", "b", None, "c")[i % 4], "k", 1, i, 5, 0.5, None) for i, t in enumerate(texts)
    ]
    rows += [(None, texts[0], None, None, None, None, None, None, None, None), rows[4]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache(), [(r[0], r[1], r[3]) for r in rows]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
