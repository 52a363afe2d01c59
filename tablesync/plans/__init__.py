"""What to copy and how it went: catalogues, schemas, ledgers, jobs, and the registered queries."""
