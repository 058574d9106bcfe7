import pytest
from pyspark.sql import types as T

#: The columns of ``documents``, with one that clashes with operator outputs.
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """DataFrame of documents from texts, or from (doc_id, text, lang, source)."""
    def make(rows):
        full = []
        for i, r in enumerate(rows):
            r = (i, r, "en", "s") if not isinstance(r, tuple) else r
            full.append((*r, len(r[1]) if r[1] is not None else None))
        return spark.createDataFrame(full, DOCS)
    return make


#: Edge texts every text operator is run over.
EDGES = [None, "", " ", "\n\n", "a", "Hello  world", "x" * 5000, "one two three " * 3000,
         "日本語のテキスト、空白なし。" * 50, "emoji 👩‍👩‍👧 and ﬁ ligaturé", "tab\tand\r\nlines\n",
         "<s> </s> <unk> <0x0A> <|endoftext|> ▁x▁▁ y", "a\x00b", "\x1c\x1d \x85 　z",
         "don't WON'T we'll 12345 ½ ²³ ________ !!!???", "same line\nsame line\nsame line"]
