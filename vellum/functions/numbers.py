from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# NUMBER without scale: 38 digits, rounds '3.6' to 4; bad text -> NULL
NUMBER = "decimal(38,0)"


def try_to_number(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string").try_cast(NUMBER)
