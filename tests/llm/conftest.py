import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operators use inside.
    *[T.StructField(c, T.StringType()) for c in ("doc", "host", "n_words", "kept", "ranges", "row", "group", "bucket", "signature", "spans")],
])


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text, ...) rows as documents with more columns of clashing names."""

    def make(rows):
        whole = [(i, t, lang, source, None if t is None else len(t), *["x"] * 10) for i, t, lang, source in rows]
        return spark.createDataFrame(whole, DOCS)

    return make


def prose(seed: int, n: int) -> str:
    """n made-up words in lines of eight, the same for the same seed."""
    out, x = [], seed * 7919 + 17
    for i in range(n):
        x = (x * 48271 + 11) % 2147483647
        word = "".join("abdeghilmnoprstu"[(x >> s) % 16] for s in range(0, 12 + x % 13, 4))
        out.append(word + ("\n" if i % 8 == 7 else " "))
    return "".join(out)


@pytest.fixture(scope="session")
def odd(documents):
    """Null, empty, blank, short, long and repeated texts, null ids, sources and languages."""
    base = prose(1, 400)
    return documents([
        (1, base, "en", "a"), (2, base, "en", "a"), (3, None, "en", "a"), (4, "", "en", None), (5, " \n\t ", None, "b"),
        (6, "one", "en", "b"), (7, "one two", "en", "b"), (8, prose(2, 60000), "en", "a"), (None, prose(3, 80), "en", "b"),
        (9, "été 🙂 naïve " * 40, "fr", "b"), (10, "x" * 5000, "en", "c"), (1, base, "en", "a"), (11, base[:1500] + prose(4, 60), "en", None),
        (12, base.replace("a", "A", 1), "en", "a"), (None, None, None, None), (13, "it's <|endoftext|> 'tis so", "en", "c"),
    ])


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])
