from millrace.functions.text import (
    number_text,
    record_checksum,
    run_digits,
    run_hour,
    sequence_id,
    zipped_map,
)

__all__ = ["number_text", "record_checksum", "run_digits", "run_hour", "sequence_id", "zipped_map"]
