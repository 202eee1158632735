"""The SQL of the quotation query on messages that do quote."""

import duckdb
from compare import compare
from test_llm_quotations import SCHEMA, conversations

from tickloom.llm.catalog import ORACLES, op6_quotation_threads


def test_quotations_equal_the_sql(spark, tmp_path):
    rows = [*conversations(5), (90, 0, "user", "Hello you"), (90, 1, "user", "On Monday bob wrote:\n> hello\n>> x\n\n\n\nFine!")]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
    found = op6_quotation_threads(spark, str(tmp_path))
    assert compare(found, connection.sql(ORACLES["op6_quotation_threads"])) is None
    assert found.filter("reply_to IS NOT NULL").count() > 15
