from station_telemetry.functions.columns import (  # noqa: F401
    battery_from_fraction,
    document_id,
    epoch_seconds,
    file_timestamp,
    frame_payload,
    framed,
    iso_to_millis,
    known_battery,
    printable_text,
    record_json,
    station_key,
    utc_date,
)
