"""Network-security logs to security events, as Spark DataFrames."""

from .functions.paths import ACCESS, FIREWALL, NSG
from .operators.events import event_array_rows, ordered_event_array, syslog_lines, union_events
from .operators.families import (
    Handler,
    accepted_records,
    family_events,
    register_operation,
    rejected_records,
    rejects,
)
from .operators.flow import flow_events, flow_tuple_errors, rule_counter_events
from .operators.gateway import access_events, firewall_events
from .operators.progress import (
    error_counts,
    event_counts,
    file_event_bounds,
    file_progress,
    file_record_counts,
    last_processed_timestamp,
    last_record_time,
)
from .operators.records import (
    dispatch_operation,
    log_file_from_records,
    records_after,
    records_before,
    sort_records,
)
from .plans.incremental import Batch, Job, Run, job_summary, run_incremental, run_polling
from .plans.status import (
    StatusTable,
    begin_time_filter,
    join_status,
    read_status,
    status_json,
    status_view,
    unprocessed_files,
    upsert_status,
    write_status,
)
from .sinks.files import file_sink, write_event_files
from .sinks.syslog import syslog_sink, write_syslog
from .sources.events import read_cef_json
from .sources.logs import (
    RESOURCE_FOLDERS,
    impossible_hours,
    list_log_files,
    parse_listing,
    read_log,
    read_log_rows,
    read_log_tail,
    read_logs,
    rejected_paths,
    split_corrupt,
)
from .streaming.stream import start_stream

__all__ = [name for name in dir() if not name.startswith("_")]
