"""Plan guards: the physical properties the scale design relies on."""

import contextlib
import io

import pytest

from conftest import SF_SMALL
import __spark_entry__ as E


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


PURE = ["topk_from_factors", "predict_pairs", "assign_to_centers", "known_split", "rmse_duplicate_pairs",
        "rmse_baseline", "cold_start", "same_cluster", "cluster_donors", "train_valid_split", "feed_parse",
        "topk_ties", "topk_blocks", "als_rec_counts", "als_topk_agrees", "als_reload", "als_wide_ids"]


@pytest.mark.parametrize("name", PURE)
def test_no_cross_products(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_nearest_centre_is_shuffle_free(spark):
    assert "Exchange" not in _plan(E.queries()["assign_to_centers"](spark, SF_SMALL))


def test_topk_limits_before_the_shuffle(spark):
    plan = _plan(E.queries()["topk_from_factors"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_recommendations_plan_no_cross_product(spark):
    from shelfwise.operators import factors
    from shelfwise.plans import models

    model = models.fitted_als(spark, SF_SMALL)
    for users in (None, spark.createDataFrame([(1,), (2,)], "user_id bigint")):
        plan = _plan(factors.recommend(model, 10, users))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # a batch reads only the folders of its users
    assert "PartitionFilters" in plan and "bucket" in plan


def test_scans_are_pruned(spark):
    plan = _plan(E.queries()["predict_pairs"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,props:string>" in plan
    assert "(vec_id#" in plan and "% 5" in plan
