"""Every operator bound to the test tables, each with the SQL that gives the same rows.

The test tables hold no job postings, so posting texts are derived from their columns.  Every
query reads whole tables; ``modulo`` only chooses which form of text a row gets.
"""

from jobtide.queries.common import Query
from jobtide.queries import analysis, extraction, integration, placetables, postings, runs, tables, textjoins, texts

ALL: dict[str, Query] = {}
for _part in (texts, tables, extraction, integration, postings, analysis, textjoins, runs, placetables):
    for _name, _query in _part.QUERIES.items():
        if _name in ALL:
            raise ValueError(f"query registered twice: {_name}")
        ALL[_name] = _query
