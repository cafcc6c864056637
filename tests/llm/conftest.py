import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

#: Names that operators use for their own columns.
CLASHES = ("size", "target", "taken", "source_size", "fp", "fingerprint", "component_id", "component", "node", "key", "hub", "kept", "n_words",
           "clean_text", "unchanged", "good", "secret_spans", "start", "length", "sequence_id", "offset", "group", "place", "part", "pair", "tf",
           "word", "n", "score", "held_out", "n_tokens", "id", "a", "b", "_row")


@pytest.fixture(scope="session")
def docs_of(spark):
    from hydrolake.llm.common import ship
    ship(spark)

    def make(rows, clashes=False):
        """Documents of (doc_id, text[, lang[, source]]) rows; with clashing extra columns if asked."""
        full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        return df.withColumns({c: F.lit(f"x_{c}") for c in CLASHES}) if clashes else df

    return make


ODD_TEXTS = [None, "", "   \n\t ", "word", " ", "é日本\U0001F600 x", "a b a b a b a b", "x" * 5000, "w " * 3000, "line one.\n\nline two.\nline one."]


@pytest.fixture()
def odd(docs_of):
    """Nulls everywhere, empty and long texts, ties and repeated rows, clashing extra columns."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[3], rows[3], (3, "another text with the same id", None, None), (None, "no id", "en", "s"), (None, None, None, None)]
    return docs_of(rows, clashes=True)
