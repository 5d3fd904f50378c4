import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, n_words bigint, ids string, n_chars bigint, u string, score string, rank string"


def prose(r, n, letters="abcdefgh"):
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(1, 3))) for _ in range(n))


def corpus():
    """Copies, near copies, shared passages, ties, nulls, empty and long texts."""
    r = random.Random(7)
    rows = [[i, prose(r, r.randint(1, 120))] for i in range(40)]
    base, passage = prose(r, 100), prose(r, 60)
    for i in range(40, 60):
        w = base.split()
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = prose(r, 1)
        rows.append([i, " ".join(w)])
    rows += [[i, prose(r, 30) + " " + passage + "\n" + prose(r, 20)] for i in range(60, 70)]
    rows += [[i, base] for i in range(70, 80)]
    rows += [[80, None], [81, ""], [82, " \t\n "], [83, "One"], [84, "one"], [85, "é Ünḯ ſK İ Σ x\x00y"], [None, base], [None, None]]
    rows += [[86, prose(r, 6000)], [87, "x" * 60_000], [88, "a " * 300], [89, base.upper()], [10, rows[10][1]], [11, prose(r, 50)]]
    lines = [prose(r, 6) for _ in range(5)]
    rows += [[i, "\n".join([prose(r, 3), *lines[: r.randint(1, 5)], prose(r, 3), *lines[1:4]])] for i in range(90, 99)]
    r.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The corpus beside columns whose names clash with those that operators use."""
    return spark.createDataFrame([(i, t, None if k % 3 else "en", 1, "x", len(t or ""), None, "s", None) for k, (i, t) in enumerate(rows)], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
