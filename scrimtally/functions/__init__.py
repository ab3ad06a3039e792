from .columns import (  # noqa: F401
    add_metrics,
    clean_role,
    display_name,
    duration_bucket,
    epoch_seconds,
    kda,
    load_stamp,
    millis_to_utc,
    normalize_id,
    patch_of,
    patch_prefix,
    patch_sort_key,
    per_minute,
    ratio,
    result_label,
    role_name,
    share_of_wins,
    to_long,
    to_utc,
    verdict,
    wilson_bounds,
)
from .labels import EN, RU, Labels  # noqa: F401
