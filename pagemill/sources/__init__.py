"""Readers and writers of the stored crawl files."""
from pagemill.sources.readers import (  # noqa: F401
    flatten_captures,
    load_blocks,
    load_captures,
    load_model_output,
    load_pages,
    load_state,
    load_url_list,
    split_blocks,
)
from pagemill.sources.schemas import PAGE, PRODUCT, VENUE, VENUE_KEYS  # noqa: F401
from pagemill.sources.writers import (  # noqa: F401
    append_jsonl,
    bundle_captures,
    json_arrays,
    markdown_lines,
    write_csv,
    write_markdown,
    write_tables,
    write_url_list,
)
