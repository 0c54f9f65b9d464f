from tripmart.sinks.tables import (
    MissingTable,
    PublishConflict,
    append_merge,
    compact,
    compact_origin,
    drop_old_versions,
    overwrite,
    publish,
    published,
    read_origins,
    resolve,
)

__all__ = [
    "MissingTable",
    "PublishConflict",
    "append_merge",
    "compact",
    "compact_origin",
    "drop_old_versions",
    "overwrite",
    "publish",
    "published",
    "read_origins",
    "resolve",
]
