"""Sinks: keyed upsert tables, record publishing, printable rows."""

from verdant.sinks.publish import formatted_rows, sent_log, to_keyed_records, write_records  # noqa: F401
from verdant.sinks.upsert import UpsertTable, path_exists  # noqa: F401
