"""String rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment codes with a standard label. Any other code is sentence-cased.
PAYMENT_LABELS = {
    "credit_card": "Credit Card",
    "boleto": "Boleto",
    "voucher": "Voucher",
    "debit_card": "Debit Card",
}


def sentence_case(text: Column) -> Column:
    """First letter upper, the rest lower (``initcap`` would capitalise every word)."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def payment_label(code: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in PAYMENT_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, F.lower(code)), sentence_case(code))
