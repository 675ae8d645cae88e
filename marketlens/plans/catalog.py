"""SQL surface: the reference's tables and views as Spark temp views.

``register_market`` exposes ``businesses``, ``business_reviews``,
``market_executions`` and the ten views under their reference names, so the
ad-hoc SQL an analyst (or agent) writes runs unchanged in ``spark.sql`` —
parsed, optimised and executed by Spark, with the same lazy plans as the
DataFrame API.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession

from marketlens.plans import views as V
from marketlens.plans.table_functions import register_functions
from marketlens.sources import warehouse as fx
from marketlens.sources.fixture import AS_OF

VIEW_NAMES = (
    "niche_opportunities", "customer_pain_points", "market_leaders", "vulnerable_players",
    "review_velocity_trends", "niche_service_gaps", "business_model_opportunities", "niche_swot_analysis",
    "business_summary", "recent_executions",
)


def register_market(spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF) -> list[str]:
    """Register base tables and views as temp views, and the parametrised queries as table functions; returns the tables' names."""
    _, r, e = fx.load_market(spark, sf_dir, as_of)
    b = fx.business_documents(spark, sf_dir)
    ex = V.execution_stats(e, b, r)
    f = fx.review_facts(spark, sf_dir, as_of)   # one review scan for all views
    tables = {
        "businesses": b,
        "business_reviews": r,
        "market_executions": ex,
        "niche_opportunities": V.niche_opportunities(b),
        "customer_pain_points": V.customer_pain_points(b, r, facts=f),
        "market_leaders": V.market_leaders(b, r, as_of, facts=f),
        "vulnerable_players": V.vulnerable_players(b, r, as_of, facts=f),
        "review_velocity_trends": V.review_velocity_trends(b, r, as_of, facts=f),
        "niche_service_gaps": V.niche_service_gaps(b, r, facts=f),
        "business_model_opportunities": V.business_model_opportunities(b, r, facts=f),
        "niche_swot_analysis": V.niche_swot_analysis(b, r, facts=f),
        "business_summary": V.business_summary(b, r, facts=f),
        "recent_executions": V.recent_executions(e, b, r),
    }
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    register_functions(spark)
    return list(tables)


def view_inventory(spark: SparkSession):
    """Which of the reference's views are registered (catalog listing)."""
    names = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    return [(v, v in names) for v in VIEW_NAMES]
