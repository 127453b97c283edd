from siltstone.sources.extract import delta_extract, full_extract, last_watermark, watermark
from siltstone.sources.tables import TableStore

__all__ = ["TableStore", "delta_extract", "full_extract", "last_watermark", "watermark"]
