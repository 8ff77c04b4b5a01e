import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents from (doc_id, text) pairs, with `lang` if three are given."""
    def make(rows, extra=()):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(rows, COLUMNS)
        for name in extra:
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit("x"))
        return df
    return make


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 != 0), int(i % 5 == 0)) for i in range(40)] + [(None, None, None), (90, None, 1)],
                                 "doc_id bigint, quality int, toxic int")
