"""Readers and writers: landing JSON, parquet tables, publish-by-swap, CSV export."""

from newsmart.sources.landing import (  # noqa: F401
    explode_articles,
    read_envelopes,
    read_landing,
    with_provenance,
)
from newsmart.sources.tables import (  # noqa: F401
    latest_partition,
    latest_partition_value,
    partition_values,
    read_partition,
    read_latest_partition,
    read_latest_written,
    read_table,
)
from newsmart.sources.writers import (  # noqa: F401
    archive_days,
    archive_files,
    claim_landing,
    export_csv,
    loose_files,
    path_exists,
    publish,
    publish_version,
    read_csv_export,
    read_current,
    write_bronze,
    write_landing,
    write_partitions,
)
