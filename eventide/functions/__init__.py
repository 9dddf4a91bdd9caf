from eventide.functions.scalar import (  # noqa: F401
    epoch_micros, from_epoch_micros, parse_duration_us, f_to_c, java_split,
    to_event_time, to_ntz, reading_text, smoke_level,
)
