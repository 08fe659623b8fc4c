"""Fixed values of the layer rules.

Results only match the original pipeline's when these are the same values:
the defaults filled in for missing text, the marks and currency the flags
test for, the sentinel, the status ladder, the SLA, the accent map and the
second timestamp layout.  They are kept here, together, so the rules read
them by name.
"""

# --- fixed values -----------------------------------------------------------
# Accented letters folded to their base letter; the two strings are aligned
# character by character (23 lower-case, then 23 upper-case).
ACCENTED = "áàãâäéèêëíìîïóòõôöúùûüçÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇ"
UNACCENTED = "aaaaaeeeeiiiiooooouuuucAAAAAEEEEIIIIOOOOOUUUUC"
# The second timestamp layout seen in the feeds (opt-in; ISO is the default).
DMY_MINUTES = "dd/MM/yyyy HH:mm"
# Money columns: decimal(10, 2).
MONEY_PRECISION, MONEY_SCALE = 10, 2
# Silver defaults for missing text.
STATE_DEFAULT = "NA"
CITY_DEFAULT = "Unknown"
CATEGORY_DEFAULT = "Unknown"
BRAND_DEFAULT = "UNKNOWN"
ORDER_STATUS_DEFAULT = "UNKNOWN"
PAYMENT_DEFAULT = "UNKNOWN"
CARRIER_DEFAULT = "Unknown"
DELIVERY_STATUS_DEFAULT = "unknown"
# The mark the product flag looks for, in category and brand alike.
MISSING_MARK = "UNKNOWN"
# Home currency: any other value, a lower-case one included, is foreign.
HOME_CURRENCY = "BRL"
# Text meaning "no value" in shipment timestamps.
NO_VALUE = "N/A"
# Gold default for missing dimension text (category and brand).
DIM_TEXT_DEFAULT = "Unknown"
# Payment method of an order fact when there is no payments table.
FACT_PAYMENT_DEFAULT = "UNKNOWN"
# Final status ladder, first match wins: delivered, else shipped, else created.
STATUS_DELIVERED, STATUS_SHIPPED, STATUS_CREATED = "DELIVERED", "SHIPPED", "CREATED"
# A delivery longer than this many hours is late (strictly greater).
SLA_HOURS = 72
# -----------------------------------------------------------------------------
