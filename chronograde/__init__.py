"""Rating-history engine: DataFrame operators for workbook ingest, type-2 history and point-in-time queries."""
