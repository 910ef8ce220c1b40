"""Column -> Column functions: strings, numbers, dates, predicates."""

from .dates import (age_calendar, covers_through, age_days365, band_calendar, band_days365, fy_rank,
                    fy_start_year, in_period, month_bucket, month_name, month_year,
                    month_year_padded, parse_dates, suspect_date)
from .numbers import clean_money, floor_div, money_round, money_sum, money_text, money_unparseable
from .predicates import (backfill_type, flag_label, national_id_eligible, not_employed_not_test,
                         not_in, on_or_after_or_null, ordered_override, outcome_counts,
                         self_reported_citizen, valid_national_id)
from .strings import (complete_seconds, contains_ci, full_name, is_blank, nfkc, normalize_email,
                      not_ilike, pad_id, replace_values, split_list, strip, strip_columns)

__all__ = [n for n in dir() if not n.startswith("_")]
