"""Property test: distributed order statistics equal pandas / numpy."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.operators.ranking import exact_quantile_long, percentile_rank_min


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=60),
       buckets=st.integers(min_value=2, max_value=9), q=st.sampled_from([0.05, 0.5, 0.9]))
def test_rank_and_quantile(spark, vals, buckets, q):
    pdf = pd.DataFrame({"wallet": [f"w{i}" for i in range(len(vals))], "v": [float(v) for v in vals]})
    df = spark.createDataFrame(pdf)
    got = percentile_rank_min(df, "v", "p", buckets=buckets).toPandas().set_index("wallet")["p"].sort_index()
    exp = pdf.set_index("wallet")["v"].rank(method="min", pct=True).sort_index()
    assert np.allclose(got, exp)
    desc = percentile_rank_min(df, "v", "p", ascending=False, buckets=buckets).toPandas().set_index("wallet")["p"]
    assert np.allclose(desc.sort_index(), pdf.set_index("wallet")["v"].rank(method="min", ascending=False, pct=True).sort_index())
    long = df.selectExpr("'g' AS g", "v")
    qv = exact_quantile_long(long, "g", "v", q, buckets).first()["quantile"]
    assert qv == pytest.approx(float(np.percentile(pdf["v"], q * 100)))
