"""Theme dictionaries and their case-insensitive whole-word flags.

All matching runs JVM-side through ``rlike`` (Java regex, inside whole-stage
codegen).  ``\\b`` stands for the reference's ``\\y`` word boundary.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The dictionaries of the strategic views, word for word.
# ---------------------------------------------------------------------------
PAIN_THEMES = {
    "pricing": "expensive|overpriced|cost|price|fee|charge|hidden|ripoff",
    "scheduling": "late|delayed|wait|schedule|appointment|time|slow",
    "quality": "poor|bad|terrible|awful|shoddy|cheap|broken|wrong",
    "communication": "rude|unprofessional|ignored|communication|response|callback",
    "availability": "unavailable|closed|weekend|emergency|24/7|never|busy",
}
STRENGTH_THEMES = {
    "professionalism": "professional|expert|knowledgeable|certified|experienced|skilled",
    "speed": "fast|quick|timely|on time|punctual|responsive|immediate",
    "pricing": "fair price|reasonable|affordable|value|transparent|upfront",
    "quality": "quality|excellent|perfect|outstanding|thorough|detailed",
}
WEAKNESS_THEMES = {
    "professionalism": "unprofessional|rude|disrespectful|arrogant|dismissive",
    "speed": "slow|late|delayed|waiting|never showed|missed appointment",
    "pricing": "expensive|overpriced|ripoff|hidden fee|upcharge",
    "quality": "poor quality|shoddy|incomplete|mistake|damage|broken",
}
HIGH_TICKET_AMOUNT = r"\$[0-9]{3,5}"
HIGH_TICKET_WORDS = "thousand|expensive|quote|estimate|bid|consultation|custom"
B2B_WORDS = "property manager|landlord|commercial|business|company|office"
B2C_WORDS = "homeowner|house|my home|residential|family|personal"
TRUST_WORDS = "scam|ripoff|dishonest|overcharge|hidden fee|bait"
SERVICE_KEYWORDS = (
    "repair", "restoration", "maintenance", "custom", "design", "emergency",
    "24/7", "weekend", "consultation", "installation", "inspection", "warranty",
)
SUCCESS_FACTORS = ("service", "quality", "friendly", "professional")  # ILIKE '%x%', first match wins


def word_regex(alternatives: str) -> str:
    """Case-insensitive whole-word pattern for a ``a|b|c`` alternation."""
    return r"(?i)\b(" + alternatives + r")\b"


def has_words(text: Column, alternatives: str) -> Column:
    """``text ~* '\\y(alternatives)\\y'``; NULL text gives NULL (treated as no match)."""
    return text.rlike(word_regex(alternatives))


def flag(pred: Column) -> Column:
    """0/1 integer of a predicate, NULL counting as 0 (FILTER semantics)."""
    return F.when(pred, F.lit(1)).otherwise(F.lit(0))


def theme_flag_columns(text: Column, stars: Column) -> dict[str, Column]:
    """All 17 dictionary flags of X4 as 0/1 columns, one regex pass each."""
    cols = {}
    for k, v in PAIN_THEMES.items():
        cols[f"pain_{k}"] = flag(has_words(text, v))
    for k, v in STRENGTH_THEMES.items():
        cols[f"strength_{k}"] = flag(has_words(text, v))
    for k, v in WEAKNESS_THEMES.items():
        cols[f"weakness_{k}"] = flag(has_words(text, v))
    cols["high_ticket"] = flag(text.rlike(HIGH_TICKET_AMOUNT) | has_words(text, HIGH_TICKET_WORDS))
    cols["b2b"] = flag(has_words(text, B2B_WORDS))
    cols["b2c"] = flag(has_words(text, B2C_WORDS))
    cols["trust"] = flag((stars <= 2) & has_words(text, TRUST_WORDS))
    return cols
