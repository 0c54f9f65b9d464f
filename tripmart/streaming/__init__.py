from tripmart.streaming.dedupe import stream_dedupe
from tripmart.streaming.landing import land_checked, land_stream, run_bronze_stream
from tripmart.streaming.newest import fold_newest, keep_newest, read_newest

__all__ = [
    "fold_newest",
    "keep_newest",
    "land_checked",
    "land_stream",
    "read_newest",
    "run_bronze_stream",
    "stream_dedupe",
]
