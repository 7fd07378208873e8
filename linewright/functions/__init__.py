from .exprs import (
    CARD_FEATURES,
    as_fixed,
    as_flag,
    defect_rate_all,
    defect_rate_labelled,
    derived_card_features,
    epoch_us,
    fixed_mean,
    from_epoch_us,
    parse_timestamp,
    percent,
    seconds_of,
    slice_start,
)

__all__ = [
    "CARD_FEATURES",
    "as_fixed",
    "as_flag",
    "defect_rate_all",
    "defect_rate_labelled",
    "derived_card_features",
    "epoch_us",
    "fixed_mean",
    "from_epoch_us",
    "parse_timestamp",
    "percent",
    "seconds_of",
    "slice_start",
]
