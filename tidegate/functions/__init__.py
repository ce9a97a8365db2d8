from tidegate.functions.device import (
    flagged,
    header,
    header_time,
    local_time,
    row_hash,
    station_id,
    utc_date,
    utc_time,
)

__all__ = ["flagged", "header", "header_time", "local_time", "row_hash", "station_id", "utc_date", "utc_time"]
