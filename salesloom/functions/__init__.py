"""Scalar column builders: text, numbers, dates, hashes, categories."""

from salesloom.functions.classify import (  # noqa: F401
    audit_category, report_section, return_rejection_class,
)
from salesloom.functions.dates import (  # noqa: F401
    calendar_columns, date_error, iso_date, month_label, month_start, parse_date,
)
from salesloom.functions.hashing import (  # noqa: F401
    payload_hash, record_hash, signature_columns, ZERO_HASH,
)
from salesloom.functions.numbers import (  # noqa: F401
    accepted, line_number, nonnegative_money, positive_integer, positive_money, promo_discount, ratio_pct, safe_ratio,
)
from salesloom.functions.text import (  # noqa: F401
    blank_default, canonical_city, canonical_payment, channel_code, clean_text, contains_any,
    is_missing, match_key, usable_text, valid_email, with_clean_text,
)
