from concurrent.futures import ThreadPoolExecutor

from plumbline.sources.runlog import claim


def test_claims_of_many_writers_differ(spark, tmp_path):
    def take(_):
        return [claim(spark, str(tmp_path / "claims"), 1) for _ in range(10)]

    with ThreadPoolExecutor(8) as pool:
        got = sum(pool.map(take, range(8)), [])
    assert sorted(got) == list(range(1, 81))
