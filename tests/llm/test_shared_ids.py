"""Rows that share an id, and columns with clashing names."""

import corpus_pipeline
from plumbline.llm import jaccard_join, line_dedup, packing

A = " ".join(f"alpha{i}" for i in range(40))
B = " ".join(f"beta{i}" for i in range(40))


def test_each_text_of_an_id_keeps_its_links(spark):
    rows = [(1, A), (2, B), (5, A + " more"), (5, B + " more"), (7, "nothing like the others at all here")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string")
        got = {(r.doc_id, r.component_id) for r in jaccard_join.near_duplicates(df).collect()}
        assert got == {(1, 1), (2, 1), (5, 1), (7, 7)}


def test_lines_go_from_their_own_text_only(spark):
    line = "one line of more than five words that two documents share"
    rows = [(1, line + "\nx first own words here now"), (2, line + "\ny second own words here now"), (2, "another text entirely with its words\nz third own words here now")]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], "doc_id long, text string, _id string, _gone string, removed_lines string")
    got = {(r.doc_id, r.text, tuple(r.removed_lines), r._id, r._gone) for r in line_dedup.deduplicated(df).collect()}
    assert got == {
        (1, rows[0][1], (), "a", "b"), (2, "y second own words here now", (0,), "a", "b"), (2, rows[2][1], (), "a", "b")}


def test_packing_and_stages_keep_extra_columns(spark):
    rows = [(i, 0, 0, 100 + i, "u", 1, 2) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, _at string, sequence_id int, offset int")
    got = packing.best_fit(df, 400).collect()
    assert len(got) == 30 and {r._at for r in got} == {"u"} and len({(r.sequence_id, r.offset) for r in got}) == 30
    text = " ".join(f"Word{i}" for i in range(60)) + "."
    docs = spark.createDataFrame([(1, text, "x")], "doc_id long, text string, _h string")
    out = corpus_pipeline.quality_rules(spark, docs, "").collect()
    assert [(r.doc_id, r._h) for r in out] in ([(1, "x")], [])
