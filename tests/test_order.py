from __future__ import annotations

import os
import random

from pyspark.sql import functions as F

from headway import storage
from headway.operators.order import in_file_order, numbered


def test_numbers_are_those_of_a_sort(spark):
    r = random.Random(4)
    rows = [(r.choice([None, 1, 2, 3, 3, 3]), r.randint(0, 50)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = sorted((x["position"], x["a"], x["b"]) for x in numbered(df, "-a", "b").collect())
    assert [g[0] for g in got] == list(range(3000))
    assert [g[1:] for g in got] == sorted(rows, key=lambda x: (x[0] is not None, -(x[0] or 0), x[1]))


def test_awkward_rows(spark):
    equal = spark.range(1000).select(F.lit(1).alias("a"), F.lit("x").alias("position"), F.lit(2).alias("_row"))
    got = numbered(equal, "a").collect()
    assert sorted(x["position"] for x in got) == list(range(1000))
    assert {x["_row"] for x in got} == {2}
    assert numbered(spark.createDataFrame([], "a int"), "a").count() == 0


def test_a_local_session_s_folder_is_new_each_time():
    a, b = storage._session_folder(), storage._session_folder()
    assert a != b
    assert all(os.path.isdir(x.removeprefix("file://")) for x in (a, b))


def test_files_of_any_name_have_an_order(spark, tmp_path):
    for k, name in enumerate(("b", "a")):
        spark.range(3 * k, 3 * k + 3).coalesce(1).write.parquet(str(tmp_path / name))
        written = next((tmp_path / name).glob("part-*.parquet"))
        (tmp_path / "whole").mkdir(exist_ok=True)
        written.rename(tmp_path / "whole" / f"{name}.parquet")
    rows = in_file_order(spark.read.parquet(str(tmp_path / "whole"))).collect()
    assert [r["id"] for r in sorted(rows, key=lambda r: r["position"])] == [3, 4, 5, 0, 1, 2]
    assert sorted(r["position"] for r in rows) == list(range(6))
