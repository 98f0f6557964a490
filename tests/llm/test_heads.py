"""Equal sets fold before texts are read again; the filter before that read loses no key."""

import pytest

from plumbline.llm import common, jaccard_join, simjoin


def test_elements_are_written_for_one_of_equal_texts_only(spark, monkeypatch):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base)) for i in range(40)] + [(40, " ".join([*base, "more"])), (41, "quite another text of a few words")]
    held, real = {}, simjoin.stage

    def staged(df, name="stage"):
        out = real(df, name)
        if "elements" in out.columns:
            held[name] = out.count()
        return out

    monkeypatch.setattr(simjoin, "stage", staged)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {**dict.fromkeys(range(41), 0), 41: 41}
    assert held == {"heads": 2, "candidates": 2}


@pytest.mark.parametrize("most", [1 << 19, 64, 1])
def test_the_filter_keeps_every_key(spark, monkeypatch, most):
    monkeypatch.setattr(common, "FILTER_WORDS", most)
    rows = spark.range(20_000).selectExpr("struct(id, id * 7 AS hash) AS id", "id AS value")
    keys = rows.where("value % 10 = 3").select("id")
    passed = {r.value for r in common.likely(rows, keys, "id").collect()}
    assert passed >= set(range(3, 20_000, 10))
    if most > 64:
        assert len(passed) < 3_000
    assert common.likely(rows, keys.limit(0), "id").count() == 0
