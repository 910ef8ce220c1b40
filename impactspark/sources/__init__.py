"""Sources (template scans, prior state) and sinks."""

from .sinks import (identify, read_report, read_sorted, read_state_version, write_csv, write_report, write_sorted,
                    write_state, write_template)
from .records import read_records
from .templates import (ORDER_COLS, SourceSpec, layout_width, layout_widths, load_all, read_blocks,
                        read_header_csv, read_positional, read_sheets, read_state, relational, scan,
                        tag)

__all__ = [n for n in dir() if not n.startswith("_")]
