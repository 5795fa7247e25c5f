"""The checkpoint folder of a session that names none."""

import pytest

from strata.session import fallback_dir


def test_warehouse_on_a_local_master_only():
    for master in ("local", "local[8]", "local[*]", "local[4, 2]"):
        assert fallback_dir(master, "/w") == "/w/_checkpoints"
    for master in ("local-cluster[3,2,1024]", "spark://host:7077", "yarn", "k8s://host"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            fallback_dir(master, "/w")
