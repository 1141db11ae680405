"""The registered queries and the SQL each is checked against."""

from landfall.queries import cleaning, inference, publishing, runs, scans, schemas

PARTS = [inference, scans, cleaning, schemas, publishing, runs]

QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}
ORACLE = {name: sql for part in PARTS for name, sql in part.ORACLE.items()}
