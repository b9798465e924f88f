import pytest

from millrace.sources import SCHEMAS, null_counts, read_table


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_declared_schema_is_the_stored_one(spark, sf_dir, name):
    stored = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    assert read_table(spark, sf_dir, name).schema == stored


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_loader_reads_every_row(spark, sf_dir, duck, name):
    expected = duck.execute(f"SELECT count(*) FROM {name}").fetchall()[0][0]
    assert read_table(spark, sf_dir, name).count() == expected


def test_unknown_table_is_refused(spark):
    with pytest.raises(ValueError, match="unknown table 'nope'"):
        read_table(spark, "/root/testdata/sf0.001", "nope")


def test_missing_and_mistyped_columns_are_named(spark, tmp_path):
    regions = spark.range(2).selectExpr("CAST(id AS int) AS r_regionkey", "'a' AS r_name")
    regions.drop("r_name").write.parquet(str(tmp_path / "a" / "region.parquet"))
    with pytest.raises(ValueError, match="no column r_name"):
        read_table(spark, str(tmp_path / "a"), "region")
    regions.selectExpr("CAST(r_regionkey AS bigint) AS r_regionkey", "r_name").write.parquet(
        str(tmp_path / "b" / "region.parquet")
    )
    with pytest.raises(ValueError, match="r_regionkey as bigint, not int"):
        read_table(spark, str(tmp_path / "b"), "region")
    regions.selectExpr("*", "1 AS more").write.parquet(str(tmp_path / "c" / "region.parquet"))
    assert read_table(spark, str(tmp_path / "c"), "region").columns == ["r_regionkey", "r_name"]


def test_null_counts(spark):
    table = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, `b.c` string")
    assert tuple(null_counts(table).first()) == (1, 2)
