"""Registered staging queries (E1-E4) over the driver tables."""

from __future__ import annotations

from airshed.plans import oracle_sql as osql
from airshed.plans import staging as st
from airshed.plans.catalog_star import landed
from airshed.plans.queries import finish, register


@register("stage_air_quality", osql.e1_sql())
def q_stage_air_quality(spark, sf):
    return finish(st.stage_air_quality(landed(spark, sf, "d1")))


@register("stage_apportionment_studies", osql.e2_sql())
def q_stage_apportionment_studies(spark, sf):
    # The whole sheet: the reference's 527-row cap is the scan_head_n operator.
    return finish(st.stage_apportionment_studies(landed(spark, sf, "d2s"),
                                                 head_n=None))


@register("stage_apportionment_book", osql.e3_sql())
def q_stage_apportionment_book(spark, sf):
    return finish(st.stage_apportionment_book(landed(spark, sf, "d2")))


@register("stage_emissions", osql.e4_sql())
def q_stage_emissions(spark, sf):
    return finish(st.stage_emissions(landed(spark, sf, "d3")))
