"""Work tables stay out of the caller's database and can be dropped; lists of ids as Python's."""

import pyarrow as pa

from verisift.llm.bpe import id_lists
from verisift.llm.common import bucketed, drop_work_tables


def test_the_caller_s_database_stays_clean(spark):
    before = {t.name for t in spark.catalog.listTables()}
    df = bucketed(spark.range(20).selectExpr("'a' k", "id"), "k", "id")
    assert {t.name for t in spark.catalog.listTables()} == before and df.count() == 20
    drop_work_tables(spark)
    assert not spark.catalog.listTables("verisift_work")


def test_id_lists():
    some = [[1, 2], [], [70_000], [0, 5, 7], []]
    column = pa.array(some, pa.list_(pa.int32()))
    assert id_lists(column) == some and id_lists(column.slice(1, 3)) == some[1:4] and id_lists(column.slice(2, 0)) == []
