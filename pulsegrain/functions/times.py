"""Reading a row's own time as epoch milliseconds (BIGINT); NULL where it cannot be read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrain.functions import variants as V
from pulsegrain.functions.scalars import instant_micros

# The zone local times are in unless a rule names another, and the form of a local time.
LOCAL_ZONE = "Europe/Paris"
_LOCAL = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}(:\d{2}(\.\d{0,9})?)?$"
_EPOCH = r"^[+-]?[0-9]{1,19}$"


def epoch_millis(row: Column, path: str, kind: str, zone: str = LOCAL_ZONE) -> Column:
    """``zone`` is that of local times, which carry none themselves."""
    content = V.text(row, path)
    if kind == "RFC2822":
        # The seconds may be missing; the cast wants them.
        ending = F.when(F.length(content) == 16, F.lit(f":00 {zone}")).otherwise(F.lit(f" {zone}"))
        return F.when(content.rlike(_LOCAL), F.unix_millis(F.concat(content, ending).try_cast("timestamp")))
    if kind == "ISO8601":
        return F.floor(instant_micros(content) / F.lit(1000).cast("decimal(5,0)")).cast("bigint")
    count = F.when(content.rlike(_EPOCH), content.try_cast("bigint"))
    return count if kind == "EpochMilli" else F.try_multiply(count, F.lit(1000).cast("bigint"))
