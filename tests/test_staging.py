from datetime import UTC, datetime
from types import SimpleNamespace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import Staging, shared_folder
from millrace.staging import clear_staged, list_folder, local_table, path_exists


def session(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, other=None: settings.get(name, other)))


def test_the_shared_folder_is_the_one_the_session_names():
    warehouse = {"spark.sql.warehouse.dir": "hdfs://n/warehouse"}
    assert shared_folder(session(**{"spark.checkpoint.dir": "hdfs://n/checkpoints/"}, **warehouse)) == "hdfs://n/checkpoints"
    assert shared_folder(session(**warehouse)) == "hdfs://n/warehouse/staging"


def test_staged_tables_are_private_and_removable(spark, tmp_path):
    one, two = Staging(spark, str(tmp_path)), Staging(spark, str(tmp_path))
    made = one.write(spark.range(5), "t")
    two.write(spark.range(3), "t")
    assert made.count() == 5 and made.schema["id"].dataType == T.LongType()
    assert len(list_folder(spark, one.root)) == 1
    one.clear()
    assert not path_exists(spark, one.root) and path_exists(spark, two.root)
    assert list_folder(spark, one.root) == []


def test_an_application_can_clear_what_it_staged(spark):
    one, two = Staging(spark), Staging(spark)
    for staging in (one, two):
        assert staging.root.startswith(shared_folder(spark))
        staging.write(spark.range(2), "t")
    clear_staged(spark)
    assert not path_exists(spark, one.root) and not path_exists(spark, two.root)


def test_local_tables(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    for rows in ([], [(1, "x"), (None, None)]):
        made = local_table(spark, rows, schema)
        assert made.schema == schema and list(map(tuple, made.collect())) == rows
    at = T.StructType([T.StructField("at", T.TimestampType())])
    moment = datetime(2021, 8, 7, 2, 0, 0, 123456, UTC)
    assert local_table(spark, [(moment,), (None,)], at).filter(F.col("at") == F.lit(moment)).count() == 1
