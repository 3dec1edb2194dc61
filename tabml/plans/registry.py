"""All registered queries and oracles."""

from tabml.plans import analysis, modelling, preparation, profiling, tuning

_MODULES = (profiling, preparation, modelling, tuning, analysis)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
