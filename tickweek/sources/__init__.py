"""Readers of the input formats and adapters over the driver tables."""

from tickweek.sources.files import (  # noqa: F401
    parse_lines,
    read_bars,
    read_delimited,
    read_documents,
    read_lines,
    read_member_list,
    read_titles,
    register,
)
