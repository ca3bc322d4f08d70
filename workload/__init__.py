"""The queries the library is checked and timed on, each with its SQL twin."""

from workload import cleaning, comparing, domains, ordering, profiling, records, sources, wrangling

MODULES = (records, domains, profiling, cleaning, ordering, wrangling, comparing, sources)


def all_queries():
    found = {}
    for module in MODULES:
        for name, (run, sql) in module.QUERIES.items():
            assert name not in found, name
            found[name] = (run, sql)
    return found
