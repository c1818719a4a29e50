"""All registered queries by name: (callable, SQL or None)."""

from salesloom.plans import audit_queries, file_queries, load_queries, quality_queries, reader_queries, sales_queries

QUERIES = {**sales_queries.QUERIES, **quality_queries.QUERIES, **load_queries.QUERIES, **audit_queries.QUERIES, **reader_queries.QUERIES, **file_queries.QUERIES}
