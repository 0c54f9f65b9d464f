"""Code lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment codes and their labels.
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
OTHER_PAYMENT = "Other"


def payment_label(code: Column) -> Column:
    """Label of a payment code; unknown codes and NULL are ``Other``."""
    label = F.lit(OTHER_PAYMENT)
    for value, text in PAYMENT_LABELS.items():
        label = F.when(code == value, text).otherwise(label)
    return label
