"""Vehicle track engine on Spark DataFrames.

The functions most programs need; the modules hold the rest.
"""

from velotrail.functions.text import (
    format_time, hemisphere, key_bucket, key_hash, row_key, set_name, split_key,
)
from velotrail.operators.cells import (
    as_row_list, as_row_map, cell_get, cell_versions, family_time_range, row_get, rows_exist, rows_get,
    rows_get_ordered, scan, scan_limit, scan_range, time_range,
)
from velotrail.operators.checks import check_and_delete, check_and_mutate, check_and_put
from velotrail.operators.distribute import deal, deal_in_order, partition_by_hash, union_sources, with_parallelism
from velotrail.operators.history import history_rows, last_of_first_n, newest_rows, page, page_numbers, track_history
from velotrail.operators.latency import batch_latency, delay_report, delays, progress_marks, throughput
from velotrail.operators.motion import dead_reckon, integrate_track
from velotrail.operators.mutations import (
    append_cells, delete_column, delete_row, delete_typed, expire_ttl, increment_cells, mutate_rows, put_cells,
    retain_versions,
)
from velotrail.operators.parse import (
    encode_track, from_cells, keyed_by_time, parse_line, score, stamp, to_cells, track_report, unstamp, with_numbers,
)
from velotrail.operators.recent import (
    keep_last_n, key_slices, latest_position, rank_range, recent_set, recent_track, set_keys, set_size, trimmed_rows,
)
from velotrail.sources.cell_table import (
    compact_cells, read_cells, write_appends, write_deletes, write_increments, write_mutations, write_puts,
)
from velotrail.sources.lines import to_files, to_topic, track_lines
from velotrail.sources.tables import (
    clean_table, compact_history, compact_recent, read_history, read_metrics, read_recent, read_rejects, snapshot, write_history,
    write_metrics, write_recent, write_rejects,
)
from velotrail.streaming.jobs import start, start_history, start_latency, start_recent
from velotrail.streaming.state import (
    read_delay_report, read_progress_marks, read_recent_state, start_delay_report, start_progress_marks, start_recent_state,
)

__all__ = [name for name in dir() if not name.startswith("_") and name not in ("functions", "operators", "plans", "sources", "streaming")]
