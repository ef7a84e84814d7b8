"""Column names: operational names in, lower-case plain names out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from dockside.rules import STORE_COLUMNS

# Names with characters that target tables do not allow.
SPECIAL_NAMES = {
    "po#": "po",
    "po#man": "po_man",
    "sku#": "sku",
    "ss#": "ss",
    "str#": "str",
    "postr#": "postr",
    "store#": "store",
    "vend#": "vend",
    "vend#1": "vend",
}

# Names the breakout report carries in its target table.
BREAKOUT_NAMES = {
    "po#man": "po_man",
    "ss#": "ss_num",
    "sku#": "sku_num",
    "parent exp date": "parent_exp_date",
    "parent stores": "parent_stores",
    "ffc web": "FFC_WEB",
    "ip web": "IP_WEB",
    "sidney web": "Sidney_WEB",
    **{column.lower(): column for _, column in STORE_COLUMNS},
}


def plain_names(rows: DataFrame, special: Mapping[str, str] = SPECIAL_NAMES) -> DataFrame:
    """Lower-case every column name, then apply the special renames."""
    lowered = [name.lower() for name in rows.columns]
    return rows.toDF(*[special.get(name, name) for name in lowered])
