"""Files, dumps, databases, schema facts and append-only ingestion."""
