from tessera.streaming.windows import (  # noqa: F401
    REGIONS, positions, classify_region, window_counts, region_window_counts,
    position_window_counts, parse_event_lines, event_time, read_replay, run_complete, run_update,
    write_windows, late_rows,
)
