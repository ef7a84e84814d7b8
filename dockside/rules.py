"""Business constants of the two datasets, and the set a caller can swap."""

from __future__ import annotations

from dataclasses import dataclass

# Distribution centres whose orders are tracked.
DC_STORES = (110, 114, 614, 116, 616, 118, 618)

# Order codes and order types.
ORDER_CODES = ("O", "D")
INBOUND_TYPES = ("P", "R")
PARENT_TYPE = "P"
CHILD_TYPE = "C"
MISSING_TYPE = "INVALID"

# Store number and the breakout column that carries it.
STORE_COLUMNS = (
    (6, "DS"),
    (16, "SH"),
    (20, "MO"),
    (22, "CS"),
    (24, "MI"),
    (26, "CH"),
    (28, "TU"),
    (30, "MB"),
    (38, "WI"),
    (40, "EA"),
    (44, "IC"),
    (48, "SF"),
    (50, "SM"),
    (54, "AP"),
    (56, "SC"),
    (58, "OM"),
    (60, "DM"),
    (62, "RH"),
    (64, "FA"),
    (70, "GF"),
    (72, "KI"),
    (74, "RS"),
    (76, "RC"),
    (78, "SP"),
    (80, "SS"),
    (82, "CF"),
    (84, "GK"),
    (86, "BL"),
    (88, "OP"),
    (90, "RO"),
    (92, "JO"),
    (94, "LI"),
    (96, "TC"),
    (98, "EN"),
    (110, "SD"),
    (114, "FFC"),
    (116, "IP"),
    (118, "Sidney"),
    (614, "FFC_WEB"),
    (616, "IP_WEB"),
    (618, "Sidney_WEB"),
)

# Rolling window and recency, in days.
DAYS_BACK = 30
DAYS_FORWARD = 60
RECENT_DAYS = 14


@dataclass(frozen=True)
class OrderRules:
    """What counts as a tracked order, and how the breakout lays out stores."""

    dc_stores: tuple = DC_STORES
    order_codes: tuple = ORDER_CODES
    inbound_types: tuple = INBOUND_TYPES
    parent_type: str = PARENT_TYPE
    child_type: str = CHILD_TYPE
    store_columns: tuple = STORE_COLUMNS
