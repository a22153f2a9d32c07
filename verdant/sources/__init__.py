"""Sources: event records (topics or files), crop CSV, weather responses, tables, test data."""

from verdant.sources.csv import read_crop_csv, stream_crop_csv  # noqa: F401
from verdant.sources.events import RECORD_SCHEMA, read_event_records, read_events_stream  # noqa: F401
from verdant.sources.observations import parse_observation_array, read_observation_files  # noqa: F401
from verdant.sources.tables import in_table_order, open_table, read_table  # noqa: F401
from verdant.sources.testdata import load_table, sensor_events, sensor_view  # noqa: F401
