import pytest

LONG = " ".join(f"word{i % 977} and" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (3, "", "en", "b"),
    (4, None, None, None),
    (None, "a text without an id", "fr", "b"),
    (5, "ÉCOLE école ÉCOLE <|endoftext|> it's  two  spaces\n\nand lines \t tabs\u00a0nbsp", "fr", "b"),
    (6, LONG, "en", "a"),
    (7, "same id twice", "en", "a"),
    (7, "same id twice", "en", "a"),
    (7, "same id, other text", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start long, wid string, tag int, slot int, "
SCHEMA += ", ".join(f"{name} int" for name in ("_doc", "_tag", "_source", "_hash", "_tie", "_rank", "mix_slot", "features", "_first", "row", "host"))


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(*r, len(r[1] or ""), i, "x", *[i] * 13) for i, r in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def components_of(ids, pairs):
    """Smallest id reachable, by plain union-find."""
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}
