import pytest

from lectern import session


def test_spread_only_where_files_are_few(spark, data):
    one = session.table(spark, data, "videos").select("id")
    cores = spark.sparkContext.defaultParallelism
    assert one.rdd.getNumPartitions() * 2 <= cores
    assert session.spread(one).rdd.getNumPartitions() == cores
    assert sorted(session.spread(one).collect()) == sorted(one.collect())
    many = spark.range(100, numPartitions=cores)
    assert session.spread(many) is many


def test_the_package_reaches_workers_once(spark, data):
    session.table(spark, data, "videos")
    held = list(spark.sparkContext._python_includes)
    assert any(x.endswith("lectern.zip") for x in held)
    session.table(spark, data, "documents")
    assert spark.sparkContext._python_includes == held


def test_cut_keeps_rows_and_uses_the_named_folder(spark, tmp_path):
    df = session.cut(spark.range(5))
    assert sorted(r["id"] for r in df.collect()) == list(range(5))
    assert spark.sparkContext.getCheckpointDir()


def test_a_cluster_must_name_its_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session)
