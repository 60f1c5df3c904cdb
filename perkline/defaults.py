"""Default parameters. Every public function takes them as arguments."""

from __future__ import annotations

from decimal import Decimal

# The accent folding map applied to transport modes (lowercase letters only).
ACCENTED = "éèêëàâäîïôöùûüç"
PLAIN = "eeeeaaaiioouuuc"
# Fixed value: what a missing mode is called.
UNKNOWN_MODE = "inconnu"

# Exact replacements of the lookup vocabulary.
MODE_LOOKUP = {
    "vélo": "velo",
    "vehicule thermique/electrique": "vehicule",
    "véhicule thermique/électrique": "vehicule",
}

# Transport modes by the distance limit that applies to them.
WALK_MODES = ("marche", "running", "marche/running")
CYCLE_MODES = ("velo", "trottinette", "roller", "skate", "velo/trottinette/autres")
# The anomaly feed watches the cycle modes without the combined label.
ANOMALY_CYCLE_MODES = ("velo", "trottinette", "roller", "skate")

# Office position (latitude, longitude) and the postcode used when an address has none.
OFFICE = (Decimal("43.565200"), Decimal("3.902900"))
DEFAULT_POSTCODE = 34970
EARTH_RADIUS_KM = 6371

# Activity cohorts and their weights.
COHORTS = (("dormant", 0.18), ("occasional", 0.32), ("regular", 0.33), ("intense", 0.17))

# Contract types accepted by the employee checks, the notification channel and the topic.
CONTRACT_TYPES = ("CDI", "CDD", "Stage", "Alternance", "Freelance")
CHANNEL = "#sport-avantages"
TOPIC = "sport_activities"

# Keys every rule document must have.
CORE_RULE_KEYS = (
    "rule_version",
    "effective_from",
    "office_address",
    "bonus_rate",
    "wellbeing_days",
    "min_activities_per_year",
    "max_km_walk_run",
    "max_km_cycle_scooter_other",
)

# Length of the trailing window, and the first day of the first rule's window.
WINDOW_DAYS = 365
OPEN_START = "1900-01-01"
