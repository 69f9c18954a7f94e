import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, lang, source) rows.

    Its extra columns have names that the operators use inside.
    """

    def make(rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for name in ("id", "key", "size", "range", "kind", "score", "a", "ranges", "rank", "range"):
                df = df.selectExpr("*", f"'x' as {name}") if name not in df.columns else df
        return df

    return make


@pytest.fixture(scope="session")
def folder(tmp_path_factory, spark):
    """Writes tables to a new folder, as the given ones lie."""

    def write(**tables):
        path = tmp_path_factory.mktemp("tables")
        for name, df in tables.items():
            df.write.parquet(f"{path}/{name}.parquet")
        return str(path)

    return write
