"""What the registered queries on models ask of the library."""

import pytest

from chunkgate.catalog import judging


def test_gbt_fit_asks_for_the_plan_s_defaults(spark, monkeypatch):
    class Asked(Exception):
        pass

    def fit(train, target, kind, params=None):
        raise Asked(kind, params or {})

    monkeypatch.setattr(judging.models, "fit", fit)
    with pytest.raises(Asked) as asked:
        judging.q_gbt_fit(spark, "/root/testdata/sf0.001")
    assert asked.value.args == ("hist_gbr", {})
