from tripmart.functions.casts import to_double, to_int, to_time
from tripmart.functions.cells import hex_cell
from tripmart.functions.codes import payment_label
from tripmart.functions.frames import decode_frames, frame_rows
from tripmart.functions.lineage import add_lineage
from tripmart.functions.metrics import duration_minutes, fare_per_mile, hour_label
from tripmart.functions.totals import mean, total

__all__ = [
    "add_lineage",
    "decode_frames",
    "duration_minutes",
    "fare_per_mile",
    "frame_rows",
    "hex_cell",
    "hour_label",
    "mean",
    "payment_label",
    "to_double",
    "to_int",
    "to_time",
    "total",
]
