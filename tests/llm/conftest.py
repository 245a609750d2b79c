import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n):
    """``n`` words that depend on the seed only."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + WORDS[(x >> 16) % len(WORDS)][:2])
    return out


def odd_documents():
    """Nulls, empties, long texts, ties, repeated rows and near copies, with clashing extra columns."""
    base = prose(1, 300)
    near = base[:150] + ["changed"] + base[151:]
    rows = [
        (1, " ".join(base), "a"),
        (2, " ".join(near), "a"),
        (3, " ".join(base), None),
        (4, None, "b"),
        (5, "", "b"),
        (6, "   \n\t ", "b"),
        (7, "one two", "c"),
        (8, "ONE two", "c"),
        (9, " ".join(prose(2, 40) * 3), "c"),
        (10, " ".join(prose(3, 30_000)), "d"),
        (10, " ".join(prose(4, 100)), "d"),
        (11, " ".join(prose(5, 100)), "d"),
        (11, " ".join(prose(5, 100)), "d"),
        (None, " ".join(base[:200]), "e"),
        (None, " ".join(prose(6, 90)), "e"),
        (12, "línea única\ncon é\x85 y más " + " ".join(prose(7, 60)), "f"),
    ]
    return [(i, t, s, k, "x") for k, (i, t, s) in enumerate(rows)]


SCHEMA = "doc_id bigint, text string, source string, size int, __row string"


@pytest.fixture(scope="session")
def odd(spark):
    """Input with nulls, ties and columns named like the operators' own."""
    return spark.createDataFrame(odd_documents(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
