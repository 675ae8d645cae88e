"""DuckDB SQL of the ten views and of the two multi-step lookups.

Designed apart from the Spark plans: label ladders are tables of limits from
which the first row that holds is taken, theme and signal counts are long
(one row per market and theme), and reviews are summed per business before
they meet a market.  Labels, limits and word lists are fixed values of the
views' definitions.
"""

from __future__ import annotations

from marketlens.functions import themes as T
from marketlens.oracle_fixture import with_market

AS_OF = "DATE '2025-10-01'"


def rounded(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def days_before(days: int) -> str:
    return f"({AS_OF} - INTERVAL {days} DAY)"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def ladder(columns: str, rows: list[tuple], holds: str, otherwise: str) -> str:
    """The label of the first row whose limits hold."""
    values = ", ".join(f"({place}, {', '.join(text(v) if isinstance(v, str) else 'NULL' if v is None else str(v) for v in row)})" for place, row in enumerate(rows))
    return f"COALESCE((SELECT arg_min(step.label, step.place) FROM (VALUES {values}) step(place, label, {columns}) WHERE {holds}), {text(otherwise)})"


def words_table(groups: list[tuple[str, dict[str, str]]]) -> str:
    """Rows (kind, theme, place, pattern) of whole-word, case-insensitive patterns."""
    rows = [f"({text(kind)}, {text(theme)}, {place}, {text(chr(92) + 'b(' + words + ')' + chr(92) + 'b')})"
            for kind, themes in groups for place, (theme, words) in enumerate(themes.items())]
    return "SELECT kind, theme, place, '(?i)' || pattern AS pattern FROM (VALUES " + ", ".join(rows) + ") w(kind, theme, place, pattern)"


SAID = """said AS (
  SELECT owner.category, owner.city, review.id AS review_id, review.business_id, review.stars, review.review_text, review.published_at
  FROM business_reviews review JOIN businesses owner ON owner.id = review.business_id)"""

NICHE_OPPORTUNITIES = with_market(f"""
WITH market AS (
  SELECT category, city, COUNT(*) AS n, SUM(review_count) AS volume, {rounded('AVG(rating)', 2)} AS mean_rating, MAX(created_at) AS newest,
    list_slice(list(business_name ORDER BY rating DESC, review_count DESC NULLS FIRST, business_name) FILTER (WHERE rating >= 4.5), 1, 3) AS best
  FROM businesses WHERE category IS NOT NULL GROUP BY category, city)
SELECT category, city, n AS business_count, mean_rating AS avg_category_rating, CAST(volume AS BIGINT) AS total_category_reviews,
  {ladder('at_least', [('HIGH_SATURATION', 50), ('MEDIUM_SATURATION', 10), ('LOW_COMPETITION', 5)], 'n >= step.at_least', 'WIDE_OPEN')} AS saturation_level,
  CAST({ladder('below, over', [('10', 5, 100), ('8', 10, None), ('6', 31, None), ('4', 51, None)], 'n < step.below AND (step.over IS NULL OR volume > step.over)', '2')} AS INTEGER) AS opportunity_score,
  best AS top_players, newest AS last_updated
FROM market
""")

_PAIN_TITLES = [("pricing", "Pricing Transparency"), ("scheduling", "Scheduling Flexibility"), ("quality", "Service Quality"),
                ("communication", "Professional Communication"), ("availability", "Availability & Hours")]
_PAIN = f"""
WITH {SAID}, sour AS (SELECT * FROM said WHERE stars <= 2 AND review_text IS NOT NULL),
pattern AS ({words_table([('pain', T.PAIN_THEMES)])}),
market AS (SELECT category, city, COUNT(*) AS n FROM sour GROUP BY category, city HAVING COUNT(*) >= 3),
mention AS (SELECT category, city, theme, COUNT(*) AS n FROM sour JOIN pattern ON regexp_matches(review_text, pattern.pattern) GROUP BY category, city, theme),
ranked AS (
  SELECT market.category, market.city, market.n, title.theme, title.title, title.place, COALESCE(mention.n, 0) AS hits
  FROM market CROSS JOIN (VALUES {', '.join(f"({text(t)}, {text(label)}, {k})" for k, (t, label) in enumerate(_PAIN_TITLES))}) title(theme, title, place)
  LEFT JOIN mention ON mention.category IS NOT DISTINCT FROM market.category AND mention.city IS NOT DISTINCT FROM market.city AND mention.theme = title.theme)
"""

CUSTOMER_PAIN_POINTS = with_market(f"""{_PAIN}
SELECT category, city, n AS total_complaints,
  {', '.join(f"MAX(hits) FILTER (theme = '{k}') AS {k}_complaints, " + rounded(f"100.0 * MAX(hits) FILTER (theme = '{k}') / n", 1) + f" AS {k}_pct" for k in T.PAIN_THEMES)},
  list(title ORDER BY hits DESC, place)[1] AS primary_pain_point,
  (SELECT string_agg(substring(review_text, 1, 100), ' | ' ORDER BY substring(review_text, 1, 100), review_id) FROM sour
   WHERE stars = 1 AND sour.category IS NOT DISTINCT FROM ranked.category AND sour.city IS NOT DISTINCT FROM ranked.city) AS sample_complaints
FROM ranked GROUP BY category, city, n
""")

SAMPLE_COMPLAINT_PIECES = with_market(f"""
WITH {SAID}, snippets AS (
  SELECT category, city, substring(review_text, 1, 100) AS snippet, review_id,
    coalesce(sum(length(substring(review_text, 1, 100)) + 3) OVER (PARTITION BY category, city ORDER BY substring(review_text, 1, 100), review_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM said WHERE stars = 1 AND review_text IS NOT NULL)
SELECT category, city, start // 2000 AS part, CASE WHEN min(start) = 0 THEN '' ELSE ' | ' END || string_agg(snippet, ' | ' ORDER BY start) AS text
FROM snippets GROUP BY category, city, part
""")

SAMPLE_COMPLAINTS = with_market(f"""{_PAIN}
SELECT sour.category, sour.city, substring(review_text, 1, 100) AS snippet, COUNT(*) AS mentions
FROM sour JOIN market ON market.category IS NOT DISTINCT FROM sour.category AND market.city IS NOT DISTINCT FROM sour.city
WHERE stars = 1 GROUP BY sour.category, sour.city, snippet
""")

MARKET_LEADERS = with_market(f"""
WITH star(value, name) AS (VALUES (1, 'oneStar'), (2, 'twoStar'), (3, 'threeStar'), (4, 'fourStar'), (5, 'fiveStar')),
known AS (SELECT * FROM businesses WHERE review_count >= 20),
deviation AS (
  SELECT known.id, SUM((star.value - COALESCE(rating, 3.0)) * (star.value - COALESCE(rating, 3.0))
      * COALESCE(TRY_CAST(json_extract_string(business_data, '$.rating.reviewsDistribution.' || star.name) AS INTEGER), 0)) AS squares
  FROM known, star GROUP BY known.id),
lately AS (SELECT business_id, COUNT(*) AS n FROM business_reviews WHERE published_at >= {days_before(90)} GROUP BY business_id),
measured AS (
  SELECT known.id, business_name, category, city, rating, review_count, website, phone,
    COALESCE(SQRT(CAST(squares AS DOUBLE) / review_count), 0.5) AS rating_variance, COALESCE(lately.n, 0) AS recent_reviews_90d,
    len(list_filter([json_extract_string(business_data, '$.social.instagrams'), json_extract_string(business_data, '$.social.facebookPages'), NULLIF(website, '')],
                    lambda found: found IS NOT NULL))::INTEGER AS digital_presence_score
  FROM known JOIN deviation USING (id) LEFT JOIN lately ON lately.business_id = known.id)
SELECT *,
  {rounded('COALESCE(rating, 0) / 5.0 * 40 + LEAST(review_count::DOUBLE / 200, 1.0) * 30 + (1.0 - LEAST(rating_variance, 1.0)) * 20 + LEAST(recent_reviews_90d::DOUBLE / 20, 1.0) * 10', 1)} AS inc_score,
  {ladder('stars, volume', [('DOMINANT_LEADER', 4.5, 100), ('STRONG_INCUMBENT', 4.3, 50), ('ESTABLISHED_PLAYER', 4.0, 30)],
          'rating >= step.stars AND review_count >= step.volume', 'EMERGING_BUSINESS')} AS market_position
FROM measured
""")

VULNERABLE_PLAYERS = with_market(f"""
WITH half AS (
  SELECT business_id, published_at >= {days_before(90)} AS recent, AVG(stars) AS mean, COUNT(*) AS n, COUNT(*) FILTER (stars <= 2) AS bad
  FROM business_reviews GROUP BY ALL),
heard AS (SELECT business_id, SUM(n) AS n FROM half GROUP BY business_id HAVING SUM(n) >= 10),
both_halves AS (
  SELECT b.id, b.business_name, b.category, b.city, b.rating AS overall_rating, b.review_count, late.mean AS recent_rating_90d, early.mean AS historical_rating,
    COALESCE(late.n, 0) AS recent_review_count, COALESCE(late.bad, 0) AS recent_negative_reviews, COALESCE(late.bad, 0)::DOUBLE / late.n AS bad_share
  FROM heard JOIN businesses b ON b.id = heard.business_id
  LEFT JOIN half late ON late.business_id = b.id AND late.recent LEFT JOIN half early ON early.business_id = b.id AND NOT early.recent)
SELECT * EXCLUDE (bad_share), {rounded('recent_rating_90d - historical_rating', 2)} AS rating_momentum,
  {rounded('''COALESCE(GREATEST((historical_rating - recent_rating_90d) / 2.0 * 40, 0), 0) + (1.0 - COALESCE(recent_rating_90d, overall_rating) / 5.0) * 30
      + bad_share * 20 + COALESCE(LEAST(review_count::DOUBLE / 100, 1.0), 1.0) * 10''', 1)} AS vulnerability_score,
  {ladder('fall, under, volume, share', [('HIGH_DISRUPTION_TARGET', 0.5, None, 50, None), ('DECLINING_INCUMBENT', None, 3.5, 30, None), ('REPUTATION_CRISIS', None, None, None, 0.3)],
          '''(step.fall IS NULL OR recent_rating_90d < historical_rating - step.fall) AND (step.under IS NULL OR recent_rating_90d < step.under)
             AND (step.volume IS NULL OR review_count > step.volume) AND (step.share IS NULL OR bad_share > step.share)''', 'MODERATE_VULNERABILITY')} AS vulnerability_classification
FROM both_halves WHERE recent_rating_90d < 3.5 OR recent_rating_90d < historical_rating - 0.2
""")

REVIEW_VELOCITY_TRENDS = with_market(f"""
WITH dated AS (
  SELECT business_id, COUNT(*) AS n, COUNT(*) FILTER (published_at >= {days_before(90)}) AS now_90,
    COUNT(*) FILTER (published_at >= {days_before(180)} AND published_at < {days_before(90)}) AS before_90
  FROM business_reviews GROUP BY business_id),
market AS (
  SELECT category, city, COUNT(*) AS business_count, SUM(GREATEST(COALESCE(n, 0), 1))::BIGINT AS total_reviews,
    COALESCE(SUM(now_90), 0)::BIGINT AS reviews_current_90d, COALESCE(SUM(before_90), 0)::BIGINT AS reviews_previous_90d
  FROM businesses LEFT JOIN dated ON business_id = id WHERE category IS NOT NULL GROUP BY category, city),
paced AS (SELECT *, reviews_current_90d::DOUBLE / reviews_previous_90d AS pace, reviews_current_90d::DOUBLE / business_count AS each FROM market
          WHERE business_count >= 3 AND reviews_previous_90d > 0)
SELECT * EXCLUDE (pace, each), {rounded('each / 90', 3)} AS velocity_per_business_per_day, {rounded('pace', 2)} AS momentum_ratio,
  {ladder('pace', [('RAPID_GROWTH', 1.5), ('GROWING', 1.1), ('STABLE', 0.9), ('DECLINING', 0.7)], 'paced.pace >= step.pace', 'RAPID_DECLINE')} AS trend_classification,
  {ladder('each', [('HOT', 30), ('WARM', 15), ('COOL', 5)], 'paced.each >= step.each', 'COLD')} AS market_temperature
FROM paced
""")

KEYWORDS = "|".join(T.SERVICE_KEYWORDS)
KEYWORD_LIST = ", ".join(text(k) for k in T.SERVICE_KEYWORDS)
_STYLES = [("Position as always-available specialist", ("emergency", "24/7", "weekend")),
           ("Emphasize premium, personalized service", ("custom", "design", "consultation")),
           ("Focus on reliability and warranty guarantees", ("repair", "restoration", "maintenance"))]

NICHE_SERVICE_GAPS = with_market(f"""
WITH {SAID},
style(keyword, advice) AS (VALUES {', '.join(f"({text(k)}, {text(advice)})" for advice, keys in _STYLES for k in keys)}),
asked AS (SELECT category, city, stars, unnest(regexp_extract_all(lower(review_text), '\\b({KEYWORDS})\\b', 1)) AS keyword FROM said),
demand AS (SELECT category, city, keyword, COUNT(*) AS wanted, AVG(stars) AS mood FROM asked GROUP BY ALL HAVING COUNT(*) >= 5),
offered AS (
  SELECT category, city, unnest(list_filter([{KEYWORD_LIST}], lambda k: contains(lower(business_name), k) OR contains(lower(business_data), k))) AS keyword
  FROM businesses),
supply AS (SELECT category, city, keyword, COUNT(*) AS offers FROM offered GROUP BY ALL),
met AS (SELECT demand.*, COALESCE(offers, 0) AS offers FROM demand LEFT JOIN supply USING (category, city, keyword))
SELECT category, city, met.keyword AS specialty_type, wanted AS customer_demand, offers AS current_providers, {rounded('mood', 2)} AS sentiment_when_mentioned,
  {rounded('wanted::DOUBLE / GREATEST(offers, 1)', 2)} AS demand_supply_ratio,
  {ladder('most_offers, least_wanted', [('CRITICAL_GAP', 0, 10), ('HIGH_OPPORTUNITY', 2, 15), ('MODERATE_GAP', 5, 20)],
          'offers <= step.most_offers AND wanted >= step.least_wanted', 'SERVED')} AS gap_status,
  COALESCE(advice, 'Differentiate on ' || met.keyword || ' expertise') AS positioning_strategy
FROM met LEFT JOIN style ON style.keyword = met.keyword
""")

BUSINESS_MODEL_OPPORTUNITIES = with_market(f"""
WITH {SAID},
signal AS ({words_table([('any', {'ticket': T.HIGH_TICKET_WORDS, 'b2b': T.B2B_WORDS, 'b2c': T.B2C_WORDS}), ('sour', {'trust': T.TRUST_WORDS})])}),
flagged AS (
  SELECT category, city, business_id,
    list_has_any(kinds, ['ticket']) OR COALESCE(regexp_matches(review_text, '\\$[0-9]{{3,5}}'), false) AS ticket, list_has_any(kinds, ['b2b']) AS b2b,
    list_has_any(kinds, ['b2c']) AS b2c, list_has_any(kinds, ['trust']) AS trust
  FROM (SELECT said.*, (SELECT COALESCE(list(theme), []) FROM signal WHERE regexp_matches(said.review_text, pattern) AND (kind = 'any' OR said.stars <= 2)) AS kinds FROM said)),
spread AS (   -- ratings weighted by reviews, as the spread is taken over reviews
  SELECT owner.category, owner.city, STDDEV_SAMP(owner.rating) AS rating_spread FROM business_reviews r JOIN businesses owner ON owner.id = r.business_id GROUP BY ALL),
market AS (
  SELECT category, city, COUNT(*) AS n, COUNT(DISTINCT business_id) AS providers, COUNT(*) FILTER (ticket) AS tickets, COUNT(*) FILTER (b2b) AS b2b,
    COUNT(*) FILTER (b2c) AS b2c, COUNT(*) FILTER (trust) AS trust, COUNT(*) FILTER (ticket)::DOUBLE / COUNT(*) AS ticket_share
  FROM flagged GROUP BY ALL HAVING COUNT(*) >= 20),
seen AS (SELECT market.*, rating_spread FROM market JOIN spread ON spread.category IS NOT DISTINCT FROM market.category AND spread.city IS NOT DISTINCT FROM market.city)
SELECT category, city, providers AS provider_count, n AS total_reviews, {rounded('100.0 * tickets / n', 1)} AS high_ticket_pct,
  {ladder('over', [('PREMIUM_PRICING', 0.25), ('HIGH_TICKET', 0.15), ('MID_TICKET', 0.08)], 'ticket_share > step.over', 'LOW_TICKET')} AS ticket_classification,
  {rounded('rating_spread', 2)} AS market_fragmentation,
  {ladder('crowd, spread, share, doubts', [('EXCELLENT_ARBITRAGE', 20, 0.6, 0.15, 5), ('GOOD_ARBITRAGE', 15, 0.4, 0.10, -1), ('MODERATE_ARBITRAGE', 10, 0.3, -1, -1)],
          'providers > step.crowd AND rating_spread > step.spread AND ticket_share > step.share AND trust > step.doubts', 'LOW_ARBITRAGE')} AS arbitrage_potential,
  b2b AS b2b_signals, b2c AS b2c_signals,
  {ladder('b2b_weight, b2c_weight', [('B2B_FOCUSED', 1, 3), ('B2C_FOCUSED', 3, 1), ('B2B_LEANING', 1, 1.5), ('B2C_LEANING', 1.5, 1)],
          'CASE WHEN step.b2b_weight = 1 THEN seen.b2b > seen.b2c * step.b2c_weight ELSE seen.b2c > seen.b2b * step.b2b_weight END', 'MIXED_MARKET')} AS customer_type,
  trust AS trust_issues, {rounded('100.0 * trust / n', 1)} AS trust_issue_pct,
  {rounded('COALESCE(LEAST(rating_spread * 40, 40), 40) + ticket_share * 30 + LEAST((trust::DOUBLE / n) * 100, 20) + LEAST((providers::DOUBLE / 50) * 10, 10)', 1)} AS newsletter_viability_score,
  {ladder('spread, share, doubts, crowd, b2b_over',
          [('High-value curation newsletter: "Vetted Premium Providers"', 0.6, 0.15, None, None, None),
           ('Trust-focused aggregator: "Certified & Reviewed Professionals"', None, None, 5, 15, None),
           ('B2B lead generation platform targeting property managers', None, None, None, None, 2),
           ('Local marketplace with quality guarantees', 0.4, None, None, 30, None)],
          '''(step.spread IS NULL OR rating_spread > step.spread) AND (step.share IS NULL OR ticket_share > step.share) AND (step.doubts IS NULL OR trust > step.doubts)
             AND (step.crowd IS NULL OR providers > step.crowd) AND (step.b2b_over IS NULL OR seen.b2b > seen.b2c * step.b2b_over)''',
          'Standard directory/referral newsletter')} AS business_model_recommendation
FROM seen
""")

#: Labels by theme, in the order professionalism, speed, pricing, quality.
STRENGTHS = ["Professionalism & Expertise", "Speed & Responsiveness", "Fair & Transparent Pricing", "Quality Workmanship"]
STRENGTH_ENTRIES = ["Professional service", "Fast response", "Fair pricing", "Quality work"]
WEAKNESSES = ["Unprofessional Conduct", "Slow/Unreliable Service", "Pricing Issues", "Quality Concerns"]
WEAKNESS_ENTRIES = ["Unprofessional behavior", "Delays & no-shows", "Overpricing & hidden fees", "Poor workmanship"]
CHANCES = ["Differentiate on professionalism: Certified technicians, background checks, communication standards",
           "Guarantee response times: Same-day service, real-time tracking, automated scheduling",
           "Transparent pricing model: Upfront quotes, price-match guarantees, no hidden fees",
           "Quality assurance program: Warranties, inspections, satisfaction guarantees"]
_TITLES = ", ".join(
    f"({text(side)}, {text(theme)}, {place}, {text(labels[place])}, {text(entries[place])}, {text(CHANCES[place])})"
    for side, labels, entries in (("strong", STRENGTHS, STRENGTH_ENTRIES), ("weak", WEAKNESSES, WEAKNESS_ENTRIES))
    for place, theme in enumerate(("professionalism", "speed", "pricing", "quality")))

NICHE_SWOT_ANALYSIS = with_market(f"""
WITH {SAID},
sided AS (SELECT *, 'strong' AS side FROM said WHERE stars >= 4 UNION ALL SELECT *, 'weak' FROM said WHERE stars <= 3),
pattern AS ({words_table([('strong', T.STRENGTH_THEMES), ('weak', T.WEAKNESS_THEMES)])}),
title(side, theme, place, label, entry, chance) AS (VALUES {_TITLES}),
size AS (SELECT category, city, side, COUNT(*) AS n FROM sided GROUP BY ALL),
mention AS (SELECT category, city, side, theme, COUNT(*) AS n FROM sided JOIN pattern ON kind = side AND regexp_matches(review_text, pattern.pattern) GROUP BY ALL),
ranked AS (
  SELECT size.category, size.city, size.side, size.n, title.place, label, entry, chance, COALESCE(mention.n, 0) AS hits
  FROM size JOIN title USING (side) LEFT JOIN mention ON mention.category IS NOT DISTINCT FROM size.category AND mention.city IS NOT DISTINCT FROM size.city
    AND mention.side = size.side AND mention.theme = title.theme),
half AS (
  SELECT category, city, side, n, list(label ORDER BY hits DESC, place)[1] AS first_label, list(chance ORDER BY hits DESC, place)[1] AS first_chance,
    COALESCE(string_agg(entry, ', ' ORDER BY place) FILTER (hits > n * CASE side WHEN 'strong' THEN 0.1 ELSE 0.15 END), '') AS entries
  FROM ranked GROUP BY category, city, side, n)
SELECT COALESCE(s.category, w.category) AS category, COALESCE(s.city, w.city) AS city,
  COALESCE(s.first_label, {text(STRENGTHS[3])}) AS primary_strength, COALESCE(s.entries, '') AS strength_list,
  COALESCE(w.first_label, {text(WEAKNESSES[3])}) AS primary_weakness, COALESCE(w.entries, '') AS weakness_list,
  COALESCE(w.first_chance, {text(CHANCES[3])}) AS strategic_opportunity,
  {ladder('good, bad', [('MATURE_MARKET', 1, 5), ('FRAGMENTED_MARKET', 0.5, 1)],
          'CASE WHEN step.good = 1 THEN s.n > w.n * step.bad ELSE w.n > s.n * step.good END', 'DEVELOPING_MARKET')} AS market_maturity,
  s.n AS total_positive_reviews, w.n AS total_negative_reviews
FROM (SELECT * FROM half WHERE side = 'strong') s FULL JOIN (SELECT * FROM half WHERE side = 'weak') w ON s.category = w.category AND s.city = w.city
WHERE COALESCE(s.n, 0) + COALESCE(w.n, 0) >= 15
""")


WORST_SHOP_COMPLAINTS = with_market("""
SELECT business_name, rating, stars, review_text
FROM business_reviews JOIN (SELECT id AS shop, business_name, rating FROM businesses WHERE category ILIKE '%auto%' ORDER BY rating NULLS LAST, id LIMIT 1) ON shop = business_id
WHERE stars <= 3 ORDER BY stars, id LIMIT 5
""")

SUCCESS_FACTOR_ROWS = with_market("""
WITH factor(word, place) AS (VALUES ('service', 1), ('quality', 2), ('friendly', 3), ('professional', 4)),
praise AS (
  SELECT business_name, (SELECT arg_min(word, place) FROM factor WHERE contains(lower(review_text), word)) AS factor
  FROM business_reviews JOIN businesses b ON b.id = business_id WHERE b.rating > 4.7 AND stars >= 4)
SELECT business_name, factor, COUNT(*) AS mentions, (SUM(COUNT(*)) OVER (PARTITION BY business_name))::BIGINT AS positive_review_count
FROM praise GROUP BY business_name, factor
""")

COMPLAINT_THEME_ROWS = with_market("""
SELECT business_name, review_text AS complaint, COUNT(*) AS mentions, (SUM(COUNT(*)) OVER (PARTITION BY business_name))::BIGINT AS complaint_count
FROM business_reviews JOIN businesses b ON b.id = business_id WHERE stars <= 2 AND contains(lower(review_text), 'fee')
GROUP BY business_name, review_text QUALIFY SUM(COUNT(*)) OVER (PARTITION BY business_name) > 3
""")

SUCCESS_FACTORS = with_market("""
WITH praise AS (
  SELECT business_name, business_reviews.id, CASE WHEN review_text ILIKE '%service%' THEN 'service' WHEN review_text ILIKE '%quality%' THEN 'quality'
      WHEN review_text ILIKE '%friendly%' THEN 'friendly' WHEN review_text ILIKE '%professional%' THEN 'professional' END AS factor
  FROM business_reviews JOIN businesses b ON b.id = business_id WHERE b.rating > 4.7 AND stars >= 4)
SELECT business_name, COUNT(*) AS positive_review_count, string_agg(factor, ', ' ORDER BY id) AS success_factors FROM praise GROUP BY business_name
""")

COMPLAINT_THEMES = with_market("""
SELECT business_name, COUNT(*) AS complaint_count, string_agg(review_text, ' | ' ORDER BY business_reviews.id) AS sample_complaints
FROM business_reviews JOIN businesses b ON b.id = business_id WHERE stars <= 2 AND review_text ILIKE '%fee%'
GROUP BY business_name HAVING COUNT(*) > 3
""")
