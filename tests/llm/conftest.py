import pytest



@pytest.fixture(autouse=True)
def importable(spark):
    from lakemart.llm.common import let_workers_import

    let_workers_import(spark)


@pytest.fixture
def documents(spark):
    """A few documents with columns whose names the operators use themselves."""
    def make(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        return frame.selectExpr(
            "doc_id", "text", "'en' as lang", "cast(null as string) as source", "1 as id", "2 as row", "3 as digest", "4 as kept",
            "5 as bucket", "6 as n", "7 as node", "8 as copies", "9 as size", "10 as length", "11 as `key`", "12 as mark", "13 as verdict")

    return make
