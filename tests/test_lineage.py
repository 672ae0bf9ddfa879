from tidemark.bindings import catalog


def test_lineage_names_the_table_file_when_it_is_a_folder(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = catalog.QUERIES["b3_lineage"](spark, str(tmp_path))
    assert got.count() == docs.count()
    assert {r.source_file for r in got.select("source_file").distinct().collect()} == {
        "documents.parquet"
    }
