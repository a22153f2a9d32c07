"""Column-expression helpers: each returns a ``Column`` and stays JVM-side."""

from verdant.functions.decode import (  # noqa: F401
    epoch_millis_to_timestamp,
    iso_text_to_timestamp,
    json_text,
    parse_json_struct,
    timestamp_to_iso_text,
    utc_instant,
    utc_wall_clock,
    value_as_text,
)
from verdant.functions.numeric import (  # noqa: F401
    clamp,
    cycle_pick,
    first_number,
    fixed2_text,
    int_prefix,
    round_half_away,
    text_to_double,
)
from verdant.functions.impute import hash_pick, hash_u32, impute_between, unit_hash  # noqa: F401
from verdant.functions.bands import band  # noqa: F401
