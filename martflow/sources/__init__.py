"""Sources: ODS CSV, the star-schema adapter, events, stored warehouse tables."""
from martflow.sources.dirty import dirty_ods_from_tpch  # noqa: F401
from martflow.sources.events import events_user_day, read_events  # noqa: F401
from martflow.sources.ods_csv import Ods, read_ods_csv, read_ods_dir, read_text_csv  # noqa: F401
from martflow.sources.tpch import (  # noqa: F401
    ods_from_tpch,
    order_lines,
    raw_ods_from_tpch,
)
from martflow.sources.warehouse import (  # noqa: F401
    read_day,
    read_partitioned,
    read_partitioned_csv,
    read_table,
)
