"""Registered queries over the traffic view (A18, flagship, windows)."""

from __future__ import annotations

from tidewater.plans import common, flagship
from tidewater.plans.registry import query

query("flagship_busiest_hours", flagship.FLAGSHIP_SQL, doubles="tpm tpm_ma_6 vs_rolling_mean_pct",
      dates="date")(flagship.run)


@query("A18_view_v", "WITH " + common.V_CTE + " SELECT * FROM v",
       doubles="response_time min_response_time max_response_time standard_deviation tpm",
       times="ts")
def a18_view_v(spark, sf_dir):
    return common.view_v(spark, sf_dir)
