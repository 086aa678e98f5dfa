import os

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def public(spark):
    """The tokenizer file of the registered queries."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def frame(spark):
    """Builds a documents table; ``None`` rows and ids are allowed."""
    def build(rows, parts=3):
        full = [(i, t, lang, "s", len(t or "")) for i, t, lang in
                [(*r, None)[:3] if len(r) < 3 else r for r in rows]]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return build


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """Writes tables the way the registered queries read them."""
    def write(**tables):
        root = str(tmp_path_factory.mktemp("tables"))
        for name, df in tables.items():
            df.write.parquet(os.path.join(root, f"{name}.parquet"))
        return root
    return write


@pytest.fixture(scope="session")
def clash(spark):
    """Adds columns under names that operators use inside."""
    def add(df):
        for name in ("fingerprint", "fingerprint_id", "key", "row", "maybe", "bucket", "score",
                     "lang_pred", "n_words", "items", "found", "id0", "mark", "part"):
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit("x"))
        return df
    return add


