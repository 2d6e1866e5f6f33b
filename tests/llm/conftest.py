import pytest


@pytest.fixture(scope="session")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, empty and very long texts, repeated rows and ties."""

    def make(rows, extra=()):
        full = [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in extra:
            df = df.withColumn(name, df["doc_id"])
        return df.repartition(3)

    return make


#: Cases every operator must take: null text, id and source, empty and blank texts, odd characters, long text.
ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \n\t ", "en", "a"),
    (4, "one", "en", "b"),
    (4, "one", "en", "b"),
    (5, "same words in the same order here", "en", "b"),
    (6, "same words in the same order here", "en", None),
    (None, "no id at all", "en", "c"),
    (7, "Ünï çödé ß 漢字 \U0001f600    <|endoftext|> it's 12,345.60!!  \r\n end", "de", "c"),
    (8, "word " * 20_000, "en", "d"),
    (9, "x" * 30_000, "en", "d"),
    (10, "\n\n\n", "fr", "d"),
]
