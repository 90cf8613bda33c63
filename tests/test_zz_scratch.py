"""Runs last: clears the scratch tables of this session."""

from tallyloom.workspace import _own_folder, clear_scratch, materialise, scratch


def test_a_block_removes_the_tables_it_owns(spark, folder, tmp_path):
    from tallyloom.plans.catalog import QUERIES

    clear_scratch(spark)
    for name in ("quantile_table", "loess_grid", "sink_bucketed", "st_upsert_sink", "index_category_rows"):
        with scratch(spark):
            QUERIES[name](spark, folder).write.parquet(f"{tmp_path}/{name}")
        own = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
        files = own.getFileSystem(spark._jsc.hadoopConfiguration())
        assert not files.exists(own) or list(files.listStatus(own)) == []
        assert spark.read.parquet(f"{tmp_path}/{name}").count() > 0


def test_scratch_is_cleared_on_request(spark):
    path = materialise(spark.range(3), "gone").inputFiles()[0]
    system = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = system.getFileSystem(spark._jsc.hadoopConfiguration())
    assert files.exists(system)
    clear_scratch(spark)
    assert not files.exists(spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark)))
