from plumbline.llm import queries


def test_repeats_of_short_lines_go(spark, tmp_path):
    rows = [(0, "les.\nAll rights reserved.\n\nfive words are in here"), (1, "all rights  RESERVED.\nkept one\n\nles."),
            (2, "rights all reserved.\nles.\nfive words are in here")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: list(r.removed_lines) for r in queries.op5(spark, str(tmp_path)).collect()}
    assert got == {0: [], 1: [0, 3], 2: [1, 2]}
