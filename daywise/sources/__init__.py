from .charset import file_profile, file_status, recode_lines, write_recoded
from .delimited import keep_sound, read_csv, read_month_table, scan_month, source_folder
from .pages import flatten_json_pages, page_completeness, page_intervals
from .text import parse_csv_positional, parse_ws_text

__all__ = [
    "file_profile",
    "file_status",
    "flatten_json_pages",
    "keep_sound",
    "page_completeness",
    "page_intervals",
    "parse_csv_positional",
    "parse_ws_text",
    "read_csv",
    "read_month_table",
    "recode_lines",
    "scan_month",
    "source_folder",
    "write_recoded",
]
