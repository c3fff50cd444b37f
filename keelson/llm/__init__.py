"""Training-data operators. ``queries()`` and ``oracle_sql()`` are what ``__spark_entry__`` registers."""


def queries():
    from keelson.llm import catalog
    return dict(catalog.QUERIES)


def oracle_sql():
    from keelson.llm import catalog
    return dict(catalog.ORACLE)
