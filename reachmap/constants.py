"""Domain values the results depend on.

Every operator takes these as default arguments, so other technology classes,
tiers, thresholds or geographies can be passed instead.
"""

from typing import NamedTuple


class Tier(NamedTuple):
    """A paired download/upload speed tier in Mbit/s."""

    name: str
    down: float
    up: float

    @property
    def speed(self) -> str:
        """Label of the download half: 0.2, 4, ..., 1000."""
        return f"{self.down:g}"


# --- fixed values -----------------------------------------------------------
# technology class letter -> technology codes
TECH_CLASSES = {
    "a": (10, 11, 12, 13),
    "c": (40, 41, 42, 43),
    "f": (50,),
    "o": (0, 20, 30, 90),
    "s": (60,),
    "w": (70,),
}

# paired tiers used for provider counts
TIERS = (
    Tier("200", 0.2, 0.2),
    Tier("4_1", 4.0, 1.0),
    Tier("10_1", 10.0, 1.0),
    Tier("25_3", 25.0, 3.0),
    Tier("100_10", 100.0, 10.0),
    Tier("250_25", 250.0, 25.0),
    Tier("1000_100", 1000.0, 100.0),
)

# unpaired thresholds of the provider table
DOWN_THRESHOLDS = (0.2, 4, 10, 25, 100, 250, 500, 1000)
UP_THRESHOLDS = (0.2, 1, 3, 10, 25, 100, 250, 500, 1000)

# technology groups of the provider table, next to 'all' and the raw codes
PROVIDER_GROUPS = {
    "adsl": (10, 11, 12, 13),
    "cable": (40, 41, 42, 43),
    "other": (0, 20, 30, 90),
}

# geography type -> block master column (the nation is the constant id '0')
GEOGRAPHIES = {
    "nation": None,
    "state": "state_fips",
    "county": "county_fips",
    "cbsa": "cbsa_code",
    "cd": "cdist_id",
    "tribal": "tribal_id",
    "place": "cplace_id",
}

# lengths of the FIPS prefixes of a 15 digit block code
STATE_LEN, COUNTY_LEN, TRACT_LEN, BLOCK_LEN = 2, 5, 11, 15

ISLAND_STATES = ("60", "66", "69", "78")
BIG_TRACT_M2 = 5e8
LARGE_PROVIDERS = (300167, 290111, 130627, 130077, 130228, 130317, 130258)

# bounding boxes for areas which cross the antimeridian: (layer, GEOID, box)
BBOX_OVERRIDES = (
    ("state", "02", (-188.148909, 51.214183, -128.77847, 71.365162)),
    ("county", "02016", (-187.75585, 51.214183, -165.77847, 57.249626)),
    ("cd115", "0200", (-188.148909, 51.214183, -128.77847, 71.365162)),
)

EARTH_RADIUS_M = 6378137.0
MAX_MERCATOR_LAT = 85.0511287798066
# ---------------------------------------------------------------------------


def class_bits(classes=TECH_CLASSES):
    """Class letter -> bit; the first letter is the most significant bit."""
    letters = list(classes)
    return {c: 1 << (len(letters) - 1 - i) for i, c in enumerate(letters)}


def combos(classes=TECH_CLASSES):
    """[(k, name)] of every non-empty technology combination, k = set of class bits."""
    bits = class_bits(classes)
    return [
        (k, "".join(c for c, b in bits.items() if k & b))
        for k in range(1, 1 << len(bits))
    ]


def combo_names(classes=TECH_CLASSES):
    return [name for _, name in combos(classes)]


def combo_layout(classes=TECH_CLASSES):
    """Combination names in export order: longest first, then alphabetical."""
    return sorted(combo_names(classes), key=lambda n: (-len(n), n))
