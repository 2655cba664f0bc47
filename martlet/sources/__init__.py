"""Readers for landed data and the explicit raw schemas."""

from martlet.sources.schemas import (  # noqa: F401
    GAMES, STREAMS, POKEDEX, HLTB, PROFILES, AUDIT, LANDING_SCHEMAS,
)
from martlet.sources.readers import (  # noqa: F401
    read_parquet, read_table, read_json, read_pages, flatten_keyed_objects,
    empty_frame, conform_to_schema, stamp_batch_time, point_read,
)
from martlet.sources.listing import before_the_end, rank_links, read_cursor_pages  # noqa: F401
from martlet.sources.inference import inferred_schema, schema_report  # noqa: F401
from martlet.sources.keyed import member_texts, read_keyed_objects  # noqa: F401
