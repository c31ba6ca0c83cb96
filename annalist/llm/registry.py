"""The queries of this package, and SQL for those that SQL can express."""

from annalist.llm import queries as q


def queries() -> dict:
    return {k: f for k, f in vars(q).items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(q.SQL)
