from eventide.sources.tables import load, readings, READING_SCHEMA  # noqa: F401
from eventide.sources.text import read_lines, parse_readings, text_lines  # noqa: F401
from eventide.sources.collection import from_collection  # noqa: F401
