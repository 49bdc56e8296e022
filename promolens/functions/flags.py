"""Flag and label column functions (JVM-side CASE expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's labels.
NO_PROMOTION = "No Promotion"
PROMOTION = "Promotion"
INDIVIDUAL = "Individual"
STORE = "Store"
UNCATEGORIZED = "Uncategorized"
UNSPECIFIED = "Unspecified"
NO_DISCOUNT_OFFER_ID = 1
ACCEPTED_STATUS = (5,)
REJECTED_STATUS = (4, 6)


def promo_flag_by_offer(offer_id: Column) -> Column:
    """'No Promotion' when the offer is the no-discount offer, else
    'Promotion' (a NULL offer id falls to the ELSE branch)."""
    return F.when(offer_id == NO_DISCOUNT_OFFER_ID, F.lit(NO_PROMOTION)).otherwise(F.lit(PROMOTION))


def is_promotion(offer_id: Column, discount: Column) -> Column:
    """Robust 0/1 flag: no promotion when the offer is the no-discount one
    or the line carries no discount."""
    return F.when((offer_id == NO_DISCOUNT_OFFER_ID) | (discount == 0), F.lit(0)).otherwise(F.lit(1))


def promo_label(flag: Column) -> Column:
    return F.when(flag == 1, F.lit(PROMOTION)).otherwise(F.lit(NO_PROMOTION))


def accepted_from_status(status: Column) -> Column:
    """1 = shipped, 0 = rejected/cancelled, NULL otherwise."""
    return (F.when(status.isin(*ACCEPTED_STATUS), F.lit(1))
            .when(status.isin(*REJECTED_STATUS), F.lit(0))).cast("int")


def customer_type(store_id: Column) -> Column:
    return F.when(store_id.isNull(), F.lit(INDIVIDUAL)).otherwise(F.lit(STORE))
