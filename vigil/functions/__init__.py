from vigil.functions.columns import (  # noqa: F401
    floor_to,
    html_escape,
    html_text,
    interval_seconds,
    is_ntz,
    mask_card,
    minutes_between,
    money,
    or_missing,
    pad_number,
    prefixed_id,
    timestamp_text,
)
