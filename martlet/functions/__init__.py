"""Column-level expressions (each returns a ``Column``; no Python UDFs)."""

from martlet.functions.text import (  # noqa: F401
    blank_to_null, is_present, trimmed, default_if_blank,
)
from martlet.functions.casts import (  # noqa: F401
    null_to_zero_int, positive_decimal, to_bool, iso_to_timestamp,
    utc_to_timestamp, safe_cast, is_rejected,
)
from martlet.functions.nested import (  # noqa: F401
    map_value, array_first, array_nth, json_text,
    map_from_json, canonical, nested_fingerprint,
)
from martlet.functions.bands import band, DURATION_BANDS  # noqa: F401
from martlet.functions.names import normalize_name, normalize_column_names  # noqa: F401
