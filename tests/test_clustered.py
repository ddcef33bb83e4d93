"""The layout clustered by intern and date: whole rows, few files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.sources.clustered import files_for, interleave, read_clustered, read_index, write_clustered
from tests.helpers import ACT_SCHEMA, D

FILES = 32


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    """A third of the rows belongs to one intern, a tenth to one of their days."""
    rng = np.random.default_rng(2)
    start = D(2023, 1, 1).toordinal()
    rows = [(int(7 if k % 3 == 0 else rng.integers(1, 400)), D.fromordinal(start + (5 if k % 30 == 0 else int(rng.integers(0, 360)))), "a", float(k))
            for k in range(12_000)]
    rows += [(None, D(2023, 2, 2), "a", 1.0), (3, None, "a", 2.0), (None, None, None, None)]
    f = spark.createDataFrame(rows, ACT_SCHEMA).cache()
    path = str(tmp_path_factory.mktemp("clustered") / "t")
    write_clustered(f, path, FILES)
    return f, path


def test_interleave(spark):
    got = spark.range(16).select(interleave(F.shiftright("id", 2).cast("int"), F.col("id").bitwiseAND(F.lit(3)).cast("int"), 2).alias("z")).collect()
    want = [((i >> 3 & 1) << 3) | ((i >> 1 & 1) << 2) | ((i >> 2 & 1) << 1) | (i & 1) for i in range(16)]
    assert [r.z for r in got] == want


@pytest.mark.parametrize("interns,dates", [(None, None), ((7, 7), None), ((20, 40), ("2023-03-01", "2023-03-14")),
                                           (None, ("2023-01-06", "2023-01-06")), ((7, 7), ("2023-01-01", "2023-12-31")), ((900, 950), None)])
def test_ranges_hold_exactly_their_rows(spark, layout, interns, dates):
    f, path = layout
    want = f
    if interns:
        want = want.where(F.col("intern_id").between(*interns))
    if dates:
        want = want.where(F.col("date").between(*[F.lit(d).cast("date") for d in dates]))
    got = read_clustered(spark, path, interns, dates)
    assert got.schema.names == f.schema.names
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_few_files_are_read_and_none_is_hot(spark, layout):
    f, path = layout
    index = read_index(spark, path)
    n = index.count()
    assert FILES / 2 <= n <= FILES and index.agg(F.max("n_rows")).first()[0] <= 3 * f.count() / n
    both = files_for(index, (100, 110), ("2023-05-01", "2023-05-14")).count()
    assert both <= n / 6
    assert files_for(index, (100, 110)).count() <= 0.6 * n and files_for(index, None, ("2023-05-01", "2023-05-14")).count() <= 0.6 * n


def test_empty_facts(spark, tmp_path):
    path = str(tmp_path / "none")
    write_clustered(spark.createDataFrame([], ACT_SCHEMA), path, 4)
    assert read_clustered(spark, path, (1, 2)).collect() == [] and read_clustered(spark, path).collect() == []
