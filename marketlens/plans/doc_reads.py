"""Filtered reads of the views, as documented for each view (Q24).

Each entry: key → (view, predicate, columns, order, limit).  Predicates are
plain SQL boolean expressions over the view's columns; the same text is used
by ``spark`` (``F.expr``) and by the SQL oracle.  ``METRO``/``BUILDING`` stand
in for the documentation's example city/category.  Top-k reads break ties on
the view's key columns so LIMIT is deterministic.
"""

from __future__ import annotations

DOC_READS = {
    "niche_opportunities__metro_open": (
        "niche_opportunities", "city = 'METRO' AND opportunity_score >= 8",
        ["category", "business_count", "opportunity_score", "saturation_level"], [], None),
    "niche_opportunities__building_cities": (
        "niche_opportunities", "category = 'BUILDING'",
        ["city", "business_count", "avg_category_rating", "opportunity_score"], [], None),
    "niche_opportunities__demand_few_providers": (
        "niche_opportunities", "business_count < 10 AND total_category_reviews > 100",
        ["category", "city", "business_count", "total_category_reviews"], [], None),
    "customer_pain_points__pricing_top10": (
        "customer_pain_points", "primary_pain_point = 'Pricing Transparency'",
        ["category", "city", "total_complaints", "pricing_pct", "sample_complaints"],
        [("pricing_pct", "desc"), ("category", "asc"), ("city", "asc")], 10),
    "customer_pain_points__availability20": (
        "customer_pain_points", "availability_pct >= 20",
        ["category", "city", "availability_complaints", "availability_pct"], [], None),
    "market_leaders__dominant": (
        "market_leaders", "market_position = 'DOMINANT_LEADER'",
        ["business_name", "category", "city", "rating", "review_count", "inc_score", "market_position"], [], None),
    "market_leaders__emerging_momentum": (
        "market_leaders", "market_position = 'EMERGING_BUSINESS' AND recent_reviews_90d >= 10",
        ["business_name", "category", "recent_reviews_90d", "inc_score"], [], None),
    "market_leaders__consistent_top10": (
        "market_leaders", "rating >= 4.5",
        ["business_name", "category", "rating", "rating_variance", "inc_score"],
        [("rating_variance", "asc"), ("id", "asc")], 10),
    "vulnerable_players__high_disruption": (
        "vulnerable_players", "vulnerability_classification = 'HIGH_DISRUPTION_TARGET'",
        ["business_name", "category", "city", "overall_rating", "recent_rating_90d", "rating_momentum",
         "vulnerability_score", "vulnerability_classification"], [], None),
    "vulnerable_players__declining": (
        "vulnerable_players", "rating_momentum < -0.5",
        ["business_name", "category", "overall_rating", "recent_rating_90d", "rating_momentum", "review_count"],
        [], None),
    "vulnerable_players__reputation_crisis": (
        "vulnerable_players", "vulnerability_classification = 'REPUTATION_CRISIS'",
        ["business_name", "category", "recent_negative_reviews", "recent_review_count", "vulnerability_score"],
        [], None),
    "review_velocity_trends__growing": (
        "review_velocity_trends", "trend_classification IN ('RAPID_GROWTH', 'GROWING')",
        ["category", "city", "business_count", "momentum_ratio", "trend_classification", "market_temperature"],
        [], None),
    "review_velocity_trends__metro_activity": (
        "review_velocity_trends", "city = 'METRO'",
        ["category", "city", "velocity_per_business_per_day", "market_temperature"], [], None),
    "review_velocity_trends__declining": (
        "review_velocity_trends", "momentum_ratio < 0.9",
        ["category", "city", "reviews_current_90d", "reviews_previous_90d", "momentum_ratio",
         "trend_classification"], [], None),
    "niche_service_gaps__always_available": (
        "niche_service_gaps",
        "specialty_type IN ('emergency', '24/7', 'weekend') AND gap_status IN ('CRITICAL_GAP', 'HIGH_OPPORTUNITY')",
        ["category", "city", "customer_demand", "current_providers", "positioning_strategy"], [], None),
    "niche_service_gaps__premium_custom": (
        "niche_service_gaps", "specialty_type IN ('custom', 'design', 'consultation') AND current_providers <= 2",
        ["category", "city", "specialty_type", "customer_demand", "sentiment_when_mentioned",
         "positioning_strategy"], [], None),
    "business_model_opportunities__viability70": (
        "business_model_opportunities", "newsletter_viability_score >= 70",
        ["category", "city", "newsletter_viability_score", "arbitrage_potential", "ticket_classification",
         "customer_type", "business_model_recommendation"], [], None),
    "business_model_opportunities__b2b_high_ticket": (
        "business_model_opportunities",
        "ticket_classification IN ('PREMIUM_PRICING', 'HIGH_TICKET') AND customer_type IN ('B2B_FOCUSED', 'B2B_LEANING')",
        ["category", "city", "high_ticket_pct", "ticket_classification", "customer_type", "b2b_signals"], [], None),
    "business_model_opportunities__trust_deficit": (
        "business_model_opportunities", "trust_issue_pct >= 10",
        ["category", "city", "trust_issues", "trust_issue_pct", "arbitrage_potential",
         "business_model_recommendation"], [], None),
    "niche_swot_analysis__fragmented": (
        "niche_swot_analysis", "market_maturity = 'FRAGMENTED_MARKET'",
        ["category", "city", "primary_weakness", "strategic_opportunity", "total_positive_reviews",
         "total_negative_reviews"], [], None),
    "niche_swot_analysis__exploitable_weaknesses": (
        "niche_swot_analysis", "primary_weakness IN ('Unprofessional Conduct', 'Pricing Issues')",
        ["category", "city", "primary_weakness", "strategic_opportunity"], [], None),
}


def sql_order(order) -> str:
    return ", ".join(f"{c} {'DESC NULLS LAST' if d == 'desc' else 'ASC NULLS FIRST'}" for c, d in order)
