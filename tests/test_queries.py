"""Every registered query against its SQL on the smallest tables; unordered queries must give rows."""

import pytest

from lodestone import plans
from tests.oracle import difference

FOLDER = "/root/testdata/sf0.001"
ORDERED = [n for n in plans.QUERIES if n.startswith("wn_")] + ["ag_median", "ag_collect_list", "ev_auc", "ev_pr_auc", "ev_roc_points", "fe_quantile"]


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, name):
    assert difference(spark, name, FOLDER) is None


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_sliced_route(spark, name):
    """The same queries when no group is allowed in one task."""
    spark.conf.set("spark.lodestone.maxGroupRows", "0")
    try:
        assert difference(spark, name, FOLDER) is None
    finally:
        spark.conf.unset("spark.lodestone.maxGroupRows")


def test_every_oracle_has_a_query():
    assert set(plans.ORACLES) <= set(plans.QUERIES)
