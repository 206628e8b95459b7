"""Where intermediates go."""

from types import SimpleNamespace

import pytest

from merchlens.session import scratch_root


def session(master, **conf):
    context = SimpleNamespace(master=master, applicationId="app-1")
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: conf.get(key, *default)), sparkContext=context)


def test_a_cluster_must_name_the_shared_folder():
    here = {"spark.sql.warehouse.dir": "/w"}
    assert scratch_root(session("local[8]", **here)).startswith("/w/scratch/")
    assert scratch_root(session("local", **here)).startswith("/w/scratch/")
    assert scratch_root(session("yarn", **{"spark.checkpoint.dir": "s3a://b/c/"})).startswith("s3a://b/c/merchlens-scratch/app-1")
    for master in ("yarn", "local-cluster[3,2,3000]", "spark://host:7077"):
        with pytest.raises(ValueError, match="share"):
            scratch_root(session(master, **here))
