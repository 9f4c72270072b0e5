"""Keys and day numbers of an entity's series."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PANEL_KEYS = ("club_nbr", "mds_fam_id")


def day_number() -> Column:
    """Days since 1970-01-01: an integer order column, so frames count days in any time zone."""
    return F.unix_date(F.col("date"))
