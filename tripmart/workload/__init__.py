"""The library's queries over the test tables, each with an equivalent SQL statement."""

from tripmart.workload.oracles import oracle_sql
from tripmart.workload.queries import queries

__all__ = ["oracle_sql", "queries"]
