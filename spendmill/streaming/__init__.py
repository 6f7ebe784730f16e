from .daily import start_daily
from .ingest import VendorFolder, folder_stream, start_drifting, start_incremental

__all__ = ["VendorFolder", "folder_stream", "start_daily", "start_drifting", "start_incremental"]
