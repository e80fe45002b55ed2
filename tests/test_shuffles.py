"""A job that writes a table leaves no shuffle files behind: they would lie on the disks until the driver collects its garbage."""

import datetime
import glob
import os

import pytest


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    names = (files.apply(i).getName() for i in range(files.length()))
    return {n for n in names if n.startswith("shuffle_")}


@pytest.fixture
def left_behind(spark):
    before = shuffle_files(spark)
    return lambda: shuffle_files(spark) - before


def test_a_shuffle_leaves_files_until_it_is_collected(spark, left_behind):
    spark.range(1000).repartition(4).write.format("noop").mode("overwrite").save()
    assert left_behind()


def test_jaccard_join(spark, left_behind):
    from formmart.llm.ngram_join import jaccard_join

    words = "a b c d e f g h i j".split()
    rows = [(i, " ".join(words[:10 - i % 3])) for i in range(12)]
    joined = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), size=3, percent=50)
    assert not left_behind()
    assert {r.component_id for r in joined.collect()} == {0}


def test_op2(spark, left_behind, tmp_path):
    from formmart.llm.q_docs import op2_ngram_jaccard_join

    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    rows = [(1, text), (2, f"{text} {text}"), (3, f"{text} {text} {text}"), (4, "something else that has nothing in common")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    before = left_behind()
    joined = op2_ngram_jaccard_join(spark, str(tmp_path))
    assert left_behind() == before
    assert {r.doc_id: r.component_id for r in joined.collect()} == {1: 1, 2: 2, 3: 2, 4: 4}


@pytest.fixture
def made(spark, tmp_path):
    """Driver tables of 40 games of six teams, four lineitems each."""
    tables = {
        "region": [("r_regionkey int, r_name string"), [(0, "WEST")]],
        "nation": [("n_nationkey int, n_name string, n_regionkey int"), [(0, "PERU", 0)]],
        "supplier": [("s_suppkey bigint, s_name string, s_nationkey int"), [(k, f"Team {k}", 0) for k in range(6)]],
        "part": [("p_partkey bigint, p_name string, p_size int"), [(k, f"big part {k}", k) for k in range(8)]],
        "orders": [("o_orderkey bigint, o_orderdate date"), [(k, datetime.date(2020, 1, 1) + datetime.timedelta(k)) for k in range(40)]],
        "lineitem": [("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, "
                      "l_tax double"), [(k, (k + i) % 8, (k + i % 2) % 6, i + 1, float(k % 7 + i), 0.25, 0.5) for k in range(40) for i in range(4)]]}
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def codecs(spark, path):
    """What the column chunks of a folder's Parquet files are packed with."""
    import pyarrow.parquet as pq

    files = glob.glob(f"{path}/**/*.parquet", recursive=True)
    metas = [pq.ParquetFile(f).metadata for f in files]
    return {m.row_group(g).column(c).compression for m in metas for g in range(m.num_row_groups) for c in range(m.num_columns)}


def test_std_player_games(spark, left_behind, made):
    from formmart.plans import q_standardize as Q

    before = left_behind()
    std = Q.q_std_player_games(spark, made)
    assert left_behind() == before
    raw = Q.raw_player_games(spark, made)
    assert codecs(spark, os.path.dirname(raw.inputFiles()[0].removeprefix("file://"))) == {"ZSTD"}
    assert sorted(map(str, std.collect())) == sorted(map(str, Q._tables(spark, made).player_games.select(std.columns).collect()))


def test_csv_to_dataset(spark, left_behind, made):
    from formmart.plans import q_standardize as Q
    from formmart.plans.fixture_mart import mart_for
    from formmart.session import work_dir

    exports = f"{work_dir(spark).removeprefix('file:')}/formmart/csv/exports/*"
    mart_for(spark, made)
    there, before = set(glob.glob(exports)), left_behind()
    out = Q.q_csv_to_dataset(spark, made)
    assert set(glob.glob(exports)) == there  # read once, then deleted
    assert left_behind() == before
    want = mart_for(spark, made).training_dataset_enriched()
    assert out.count() == want.count() > 0


def test_exports_are_packed_and_read_back_whole(spark, tmp_path):
    from formmart.sources import csv as CSV

    rows = [(str(i), None if i % 3 else f'say "{i}", twice') for i in range(2000)]
    path = CSV.write_raw_csv(spark.createDataFrame(rows, "a string, b string").repartition(3), f"{tmp_path}/x")
    files = [f for f in os.listdir(path) if not f.startswith((".", "_"))]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert sorted((r.a, r.b) for r in CSV.read_raw_csv(spark, path).collect()) == sorted(rows, key=lambda r: r[0])
