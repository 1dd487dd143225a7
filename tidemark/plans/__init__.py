"""Query catalogue: each module holds QUERIES and, where SQL can say it, ORACLE."""
