import pytest

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
# Names the operators use inside; extra columns must not disturb them.
CLASHING = (
    "_id", "_norm", "_copy", "part", "n", "rank", "key", "digest", "node", "kept", "words", "_nth", "_kept", "_digest",
    "_size", "_words", "_draw", "_draws", "_shard", "_place", "row", "draw", "size", "component_id", "unnamed", "id", "rest",
)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text[, lang, source]) as documents with extra columns of clashing names."""

    def make(rows):
        full = [(*r, *(None, "web")[len(r) - 2 :], len(r[1] or "")) if len(r) < 4 else (*r, len(r[1] or "")) for r in rows]
        schema = SCHEMA + "".join(f", `{name}` string" for name in CLASHING)
        return spark.createDataFrame([(*r, *CLASHING) for r in full], schema)

    return make


AWKWARD = [
    (1, "the quick brown fox jumps over the lazy dog " * 30),
    (2, "the quick brown fox jumps over the lazy dog " * 30),
    (3, "the  quick brown\tfox jumps over the lazy dog\n" * 30),
    (4, None),
    (5, ""),
    (6, " \t\n"),
    (7, "one two three"),
    (8, "One  two three"),
    (9, "ümläut 漢字 😀 <|endoftext|> don't 12345    x" * 3),
    (10, "a" * 5000),
    (11, "word " * 60000),
    (12, None),
    (13, "12 34 !!"),
    (7, "one two three"),
    (None, "no id at all but some words in it"),
    (14, "alpha beta gamma delta epsilon zeta eta theta", None, None),
    (15, "alpha beta gamma delta epsilon zeta eta theta", "xx", ""),
]


@pytest.fixture(scope="session")
def awkward(make_docs):
    return make_docs(AWKWARD)


@pytest.fixture(scope="session")
def no_docs(awkward):
    return awkward.limit(0)
