import pytest

from quillwatch import session


class Settings:
    def __init__(self, **values):
        self.values = {k.replace("_", "."): v for k, v in values.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Settings(spark_master="yarn"))


def test_configured_folder_wins():
    spark = Settings(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/")
    assert session.fresh_path(spark, "edges").startswith("hdfs:///shared/quillwatch/edges-")


def test_local_session_without_setting_gets_one_folder():
    spark = Settings(spark_master="local[2]")
    assert session.shared_folder(spark) == session.shared_folder(spark)


def test_materialized_table_starts_a_new_plan(spark):
    df = spark.range(5).selectExpr("id", "id * 2 AS twice")
    table = session.materialize(df, "numbers")
    assert table.dtypes == df.dtypes and table.count() == 5
    assert "Range" not in table._jdf.queryExecution().optimizedPlan().toString()
