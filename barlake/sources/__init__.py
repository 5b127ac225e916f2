from barlake.sources.archives import archive_manifest, parse_lines, read_archives, unzip_bars, unzip_lines
from barlake.sources.csv_bars import CheckedBars, quarantine_bars, scan_bars_csv, scan_named_files
from barlake.sources.manifest import file_manifest, landed_units, missing_from, units_exist
from barlake.sources.symbols import read_symbols
from barlake.sources.units import only_units

__all__ = [
    "CheckedBars", "quarantine_bars",
    "archive_manifest", "file_manifest", "landed_units", "missing_from", "only_units",
    "parse_lines", "read_archives", "read_symbols", "scan_bars_csv", "scan_named_files",
    "units_exist", "unzip_bars", "unzip_lines",
]
