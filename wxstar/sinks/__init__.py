"""Writers: partitioned Parquet, year replace, atomic table replace, bucketed fact layout,
materialisation and output namespaces."""

from wxstar.sinks.parquet import (  # noqa: F401
    atomic_replace,
    load_together,
    read_loaded,
    conform,
    materialize,
    replace_undated,
    replace_years,
    table_name,
    bucket_count,
    write_bucketed,
    write_bucketed_fact,
    write_partitioned,
    write_quarantine,
    write_station_days,
    write_stations,
)
