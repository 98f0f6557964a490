"""The network learns outside the driver."""

import os

import numpy as np

from plumbline.llm import toxicity


def test_network_learns_in_a_task_and_not_in_the_driver(spark, tmp_path, monkeypatch):
    real, note = toxicity.fit, str(tmp_path / "pid")

    def noted(texts, labels):
        with open(note, "w") as file:
            file.write(str(os.getpid()))
        return real(texts, labels)

    monkeypatch.setattr(toxicity, "fit", noted)
    rows = [(i, f"word{i % 7} and {'bad' if i % 3 == 0 else 'good'} ones", int(i % 3 == 0)) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    net = toxicity.trained(docs, labels)
    with open(note) as file:
        assert int(file.read()) != os.getpid()
    own = sorted((str(i), t, y) for i, t, y in rows if not toxicity.held_out(i))
    want = real([t.encode() for _, t, _ in own], [y for _, _, y in own]).p
    assert want.keys() == net.p.keys()
    assert all(net.p[k].shape == v.shape and np.allclose(net.p[k], v, atol=1e-3) for k, v in want.items())
