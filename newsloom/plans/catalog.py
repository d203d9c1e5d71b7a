"""All registered queries by name, with their SQL twins where SQL can express them."""

from newsloom.plans import graph_queries, model_queries, report_queries, source_queries, stream_queries

_MODULES = (source_queries, report_queries, model_queries, stream_queries, graph_queries)


def all_queries():
    return {name: run for module in _MODULES for name, (run, _) in module.QUERIES.items()}


def all_sql():
    return {name: sql for module in _MODULES for name, (_, sql) in module.QUERIES.items() if sql is not None}
