"""Writers of the output formats and catalog table management."""

from tickweek.sinks.files import (  # noqa: F401
    key_value_line,
    land,
    write_bare_csv,
    write_csv,
    write_delimited,
    write_documents,
    write_key_value_lines,
)
from tickweek.sinks.tables import (  # noqa: F401
    create_external_table,
    create_table_as,
    drop_table,
    insert_into,
    create_bucketed_table_as,
)
