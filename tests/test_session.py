from pyspark.sql import functions as F

from docloom import session


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_materialise_and_spread(spark):
    df = spark.range(10).coalesce(1)
    assert session.spread(df).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    shuffled = spark.range(10).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    assert session.spread(shuffled) is shuffled
    assert session.materialise(df, "t").count() == 10


def test_package_reaches_the_workers(spark):
    session.ship(spark)
    session.ship(spark)

    def name(batches):
        import docloom

        for b in batches:
            yield b.assign(name=docloom.__name__)[["name"]]

    assert {r.name for r in spark.range(3).mapInPandas(name, "name string").collect()} == {"docloom"}


def test_a_cluster_needs_a_shared_folder():
    import types

    import pytest

    none = types.SimpleNamespace(isDefined=lambda: False)
    jsc = types.SimpleNamespace(sc=lambda: types.SimpleNamespace(getCheckpointDir=lambda: none))
    context = types.SimpleNamespace(getConf=lambda: {}, _jsc=jsc, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        session.shared_dir(types.SimpleNamespace(conf={}, sparkContext=context))


def test_only_small_inputs_are_spread(spark, tmp_path):
    one = spark.range(100).coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    narrow = one.where("id > 3").select(F.col("id") + 1, F.explode(F.array(F.lit(1), F.lit(2))))
    assert session.spread(narrow).rdd.getNumPartitions() == cores
    wide = spark.range(100).repartition(2 * cores)
    assert session.spread(wide) is wide
    joined = one.join(one.withColumnRenamed("id", "j"), F.col("id") == F.col("j"))
    assert session.spread(joined) is joined
