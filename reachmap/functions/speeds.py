"""Technology classes, tiers and labels as expressions on a named column.

They are written as SQL text: one parsed expression instead of a long chain of
column calls, each of which costs a round trip to the JVM.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import TECH_CLASSES, TIERS, class_bits


def _case(column: str, pairs, default: str = "null") -> Column:
    """CASE with (values, result) pairs of SQL literals."""
    whens = " ".join(
        f"when `{column}` in ({', '.join(str(v) for v in values)}) then {result}"
        for values, result in pairs
    )
    return F.expr(f"case {whens} else {default} end")


def tech_class(column: str, classes=TECH_CLASSES) -> Column:
    """Class letter of a technology code, null for a code of no class."""
    return _case(column, ((codes, f"'{c}'") for c, codes in classes.items()))


def tech_class_bit(column: str, classes=TECH_CLASSES) -> Column:
    """Class bit of a technology code, 0 for a code of no class."""
    bits = class_bits(classes)
    return _case(column, ((codes, bits[c]) for c, codes in classes.items()), "0")


def meets(tier) -> Column:
    """Whether max_down and max_up reach a tier."""
    return F.expr(f"max_down >= {tier.down}D and max_up >= {tier.up}D")


def tier_speed_of_file(column: str) -> Column:
    """Download speed from a file name `block_numprov_<down>_<up>.csv`; 200 is in kbit/s."""
    part = f"element_at(split(element_at(split(`{column}`, '/'), -1), '[_.]'), 3)"
    return F.expr(f"if({part} = '200', 0.2D, cast({part} as double))")


def speed_label(column: str, tiers=TIERS) -> Column:
    """Speed as text without a trailing `.0`, by tier name."""
    return _case(column, (([f"'{t.name}'"], f"'{t.speed}'") for t in tiers))


def tier_rank(column: str, tiers=TIERS) -> Column:
    """Position of a tier, so that sorting by speed is numeric."""
    return _case(column, (([f"'{t.name}'"], i) for i, t in enumerate(tiers)))
