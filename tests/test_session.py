from types import SimpleNamespace

import pytest

from plumbline.session import shared_dir, stage


def session(folder, master):
    conf = SimpleNamespace(get=lambda key, default=None: folder if folder else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app"))


def test_the_folder_the_session_names_is_used():
    assert shared_dir(session("/shared/x/", "yarn")) == "/shared/x"


def test_only_a_local_session_gets_its_own_folder():
    mine = shared_dir(session(None, "local[8]"))
    assert mine == shared_dir(session(None, "local[8]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session(None, "yarn"))


def test_staged_rows_come_back(spark):
    df = stage(spark.range(5).selectExpr("id", "array(id) as a"), "probe")
    assert df.count() == 5 and df.columns == ["id", "a"]
