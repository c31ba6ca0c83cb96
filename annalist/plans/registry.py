"""Named queries over the test tables, each with equivalent SQL."""

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _load() -> None:
    from annalist.plans import cleaning, history, labels, merging, relations  # noqa: F401  they register themselves


def queries() -> dict:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
