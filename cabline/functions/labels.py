"""Small text/label expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Erraticness labels by (int)(erraticness / 2.5).
ERRATICNESS_STEP = 2.5
ERRATICNESS_LABELS = ["calm", "busy"]
ERRATICNESS_OTHER = "crazy"

# Fixed value: ISO-8601 instant text of window ends (UTC).
ISO_INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def erraticness_label(e) -> Column:
    e = F.col(e) if isinstance(e, str) else e
    level = (e / F.lit(ERRATICNESS_STEP)).try_cast("int")
    out = F.lit(ERRATICNESS_OTHER)
    for i in reversed(range(len(ERRATICNESS_LABELS))):
        out = F.when(level == F.lit(i), F.lit(ERRATICNESS_LABELS[i])).otherwise(out)
    return out


def iso_instant(ts) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(ts, ISO_INSTANT_FORMAT)
