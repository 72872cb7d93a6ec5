import gc
import os
import time

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as entry
from veclode import session, sinks
from veclode.functions.vectors import dense_to_sparse
from veclode.operators.lsh import generated_params, lsh_index
from veclode.plans import jobs
from veclode.sources.lines import numbered_lines
from veclode.sources.lsh_files import read_lsh_params


@pytest.fixture
def conf(spark):
    """Set options and take them back."""
    before = {}

    def put(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


@pytest.mark.parametrize("split", [40, 1000, 1 << 27])
@pytest.mark.parametrize("batch", [3, 10_000])
def test_keys_do_not_depend_on_splits(spark, write, tmp_path, conf, split, batch):
    texts = {"b": [f"line {i} " + "x" * (i % 13) for i in range(60)], "a": ["", "one", ""], "c": ["last"] * 7}
    for name, own in texts.items():
        write(f"t/{name}", "\n".join(own) + "\n")
    write("t/empty", "")
    conf("spark.sql.files.maxPartitionBytes", str(split))
    conf("spark.sql.files.openCostInBytes", "1")
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    rows = numbered_lines(spark, str(tmp_path / "t")).orderBy("key").collect()
    expected = [(name, i, line) for name in sorted(texts) for i, line in enumerate(texts[name])]
    assert [r["key"] for r in rows] == list(range(len(expected)))
    assert [(os.path.basename(r["file"]), r["line"], r["value"]) for r in rows] == expected


def test_a_cluster_needs_a_shared_folder():
    assert session.checkpoints_below("file:/w", "local[4]") == "file:/w/checkpoints"
    assert session.checkpoints_below("hdfs://n/w", "yarn") == "hdfs://n/w/checkpoints"
    for warehouse in ("file:/w", "/w"):
        for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                session.checkpoints_below(warehouse, master)


def test_job_keys_do_not_depend_on_splits(spark, write, tmp_path, conf):
    train = write("train/a", "".join(f"{i % 2},{i}.0,{i % 3}.0\n" for i in range(200)))
    test = write("test/a", "".join(f"1,{i}.5,0.5\n" for i in range(40)))
    bare = write("bare/a", "".join(f"(2,[0],[{i}.5])\n" for i in range(100)))
    params = generated_params("angle", 2, family_size=2, tables=1, chain=2, seed=3)
    found = []
    for size in (150, 1 << 27):
        conf("spark.sql.files.maxPartitionBytes", str(size))
        conf("spark.sql.files.openCostInBytes", "1")
        rows = jobs.variance_vectors(spark, train, test, str(tmp_path / f"v{size}"), 2).collect()
        keyed = sorted((r["key"], r["split"], r["features"]["values"]) for r in rows)
        hashed = jobs.hash_vectors(spark, bare, str(tmp_path / f"h{size}"), params).collect()
        found.append((keyed, sorted((r["id"], r["features"]["values"]) for r in hashed)))
    assert found[0] == found[1]
    keyed, hashed = found[0]
    assert [k for k, _, _ in keyed] == list(range(240)) and keyed[7][2] == [7.0, 1.0] and keyed[200][2] == [0.5, 0.5]
    assert hashed[0] == (-100, [99.5]) and hashed[-1] == (-1, [0.5])


def test_no_lines(spark, write, tmp_path):
    write("t/empty", "")
    assert numbered_lines(spark, str(tmp_path / "t")).collect() == []


def test_writers_know_what_they_wrote(spark, tmp_path):
    df = spark.range(50).select(F.col("id").cast("string").alias("x"))
    path = str(tmp_path / "w")
    written = sinks.write_lines(df, F.concat(F.lit("line "), "x"), path, 3)
    assert written.rows == 50
    sinks.check_written(spark, path, written)
    assert written == sinks.read_back(spark, path)
    part = next(p for p in sorted(os.listdir(path)) if p.startswith("part-"))
    with open(os.path.join(path, part)) as f:
        text = f.read()
    for other in ("", text.replace("line 1", "line 2"), text + "line 7\n"):
        if other != text:
            with open(os.path.join(path, part), "w") as f:
                f.write(other)
            crc = os.path.join(path, f".{part}.crc")
            if os.path.exists(crc):
                os.remove(crc)
            with pytest.raises(ValueError, match="not Written"):
                sinks.check_written(spark, path, written)
    none = sinks.write_lines(df.limit(0), F.col("x"), str(tmp_path / "none"))
    assert none == sinks.Written(0, 0)


def test_split_and_histogram_counts(spark, tmp_path):
    rows = [(i, [float(i), 1.0], "test" if i < 3 else "training") for i in range(10)]
    df = spark.createDataFrame(rows, "key int, features array<double>, split string")
    df = df.withColumn("features", dense_to_sparse(F.col("features")))
    written = sinks.write_split(df, str(tmp_path / "s"), "text")
    assert {k: w.rows for k, w in written.items()} == {"training": 7, "test": 3}
    counts = spark.createDataFrame([(1, 5, 2), (0, 9, 1), (0, -1, 3)], "table_id int, bucket bigint, n bigint")
    path = str(tmp_path / "h")
    assert sinks.write_histogram(counts, path, "text").rows == 3
    lines = numbered_lines(spark, path).orderBy("key").collect()
    assert [r["value"] for r in lines] == ["0\t-1\t3", "0\t9\t1", "1\t5\t2"]


@pytest.mark.parametrize("family", ["angle", "pstable"])
@pytest.mark.parametrize("dist", ["gaussian", "uniform_sign"])
def test_generated_coefficients(spark, family, dist):
    params = generated_params(family, 50, family_size=8, tables=3, chain=4, seed=5, w=2, dist=dist)
    members = list(params.used_members)
    a = params.coefficients(np.arange(50))
    assert a.shape == (50, len(members)) and (params.coefficients(np.array([7])) == a[7]).all()
    rng = np.random.default_rng(1)
    x = rng.choice([0.0, 1.0, -2.0], (30, 50))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id int, d array<double>")
    df = df.withColumn("s", dense_to_sparse(F.col("d")))
    options = {"chain": "first"} if family == "pstable" else {}
    hashed = lsh_index(lsh_index(df, params, "d", out="of_d", **options), params, "s", out="of_s", **options)
    rows = hashed.orderBy("id").collect()
    dots = (x @ a)[:, np.searchsorted(members, params.drawn)]
    for i, r in enumerate(rows):
        if family == "angle":
            bits = (dots[i] > 0) @ (1 << np.arange(3, -1, -1))
        else:
            bits = np.floor((dots[i] + params.b) / params.w)[:, 0]
        assert r["of_d"] == r["of_s"] == bits.astype(int).tolist()


def test_generated_coefficients_are_normal():
    params = generated_params("angle", 1 << 40, family_size=20, tables=20, chain=8, seed=6)
    indices = np.random.default_rng(2).integers(0, 1 << 40, 20_000)
    a = params.coefficients(indices)
    assert abs(a.mean()) < 0.01 and abs(a.std() - 1) < 0.01
    correlation = np.corrcoef(a.T) - np.eye(a.shape[1])
    assert np.abs(correlation).max() < 0.05
    neighbours = params.coefficients(np.arange(20_000))
    assert abs(np.corrcoef(neighbours[1:, 0], neighbours[:-1, 0])[0, 1]) < 0.03
    for wrong in ({"family": "none"}, {"dist": "none"}, {"chain": 64}):
        with pytest.raises(ValueError):
            generated_params(**{"family": "angle", "dim": 3, "family_size": 2, "tables": 1, "chain": 2, "seed": 1, **wrong})


def test_wide_vectors_are_not_shuffled(spark):
    params = generated_params("angle", 3_000_000, family_size=100, tables=10, chain=16, seed=7)
    vector = F.struct(F.lit(3_000_000).alias("size"), F.array(F.lit(5), F.lit(2_999_999)).alias("indices"),
                      F.array(F.lit(1.0), F.lit(-1.0)).alias("values"))
    df = spark.range(5).select("id", vector.alias("features"))
    hashed = lsh_index(df, params)
    assert "Exchange" not in hashed._jdf.queryExecution().executedPlan().toString()
    assert len({tuple(r["buckets"]) for r in hashed.collect()}) == 1
    wrong = df.withColumn("features", F.col("features").withField("size", F.lit(7)))
    with pytest.raises(PySparkException, match="dimensions"):
        lsh_index(wrong, params).collect()


def test_chains_across_files(spark, write, tmp_path):
    write("f/a", "(2,[0],[1.0])\n(2,[1],[1.0])\n(2,[0,1],[1.0,1.0])\n")
    write("f/b", "(2,[0,1],[1.0,-1.0])\n")
    params = read_lsh_params(spark, str(tmp_path / "f"), "angle", 2)
    assert params.a.tolist() == [[[1.0, 0.0], [0.0, 1.0]], [[1.0, 1.0], [1.0, -1.0]]]
    with pytest.raises(ValueError, match="do not make up"):
        read_lsh_params(spark, str(tmp_path / "f"), "angle", 3)


def kept_folders(spark):
    gc.collect()
    spark._jvm.System.gc()
    session.release_unused(spark)
    folder = session.ensure_checkpoint_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(folder) if f.startswith("table-")}


def test_tables_go_when_nothing_reads_them(spark):
    before = kept_folders(spark)
    table = session.cut_lineage(spark.range(10))
    derived = table.filter("id > 3").groupBy((F.col("id") % 2).alias("k")).count()
    del table
    assert len(kept_folders(spark) - before) == 1
    assert derived.count() == 2  # what is derived from a table keeps it
    del derived
    for _ in range(20):  # Spark itself lets go of the last queries' plans by and by
        if not kept_folders(spark) - before:
            break
        spark.range(2).repartition(2).groupBy("id").count().collect()
        time.sleep(0.2)
    assert kept_folders(spark) - before == set()
    table = session.cut_lineage(spark.range(10))
    session.release(table)
    session.release(table)
    assert kept_folders(spark) - before == set()
    with pytest.raises((PySparkException, Py4JJavaError), match="FILE_NOT_EXIST"):
        table.collect()


def test_a_query_run_ten_times_leaves_no_growth(spark):
    sf_dir = "/root/testdata/sf0.001"
    if not os.path.isdir(sf_dir):
        pytest.skip("tables not here")
    sizes = []
    for _ in range(10):
        entry.own_queries()["chisq_select"](spark, sf_dir).collect()
        sizes.append(len(kept_folders(spark)))
    assert max(sizes[1:]) <= sizes[0]
