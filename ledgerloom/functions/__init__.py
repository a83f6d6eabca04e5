from ledgerloom.functions.keys import KeyScheme, date_key, hash_key, nullable_hash_key
from ledgerloom.functions.measures import AMOUNT, PRICE, cost_amount, gross_amount, margin_amount

__all__ = [
    "AMOUNT",
    "PRICE",
    "KeyScheme",
    "cost_amount",
    "date_key",
    "gross_amount",
    "hash_key",
    "margin_amount",
    "nullable_hash_key",
]
