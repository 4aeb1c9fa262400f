"""The queries of this package and the SQL of those that SQL can express."""

from starload.llm import (
    exact_dedup,
    fingerprints,
    hmm,
    infill,
    language,
    mixing,
    packing,
    passages,
    pii,
    resampling,
    sharding,
    simhash,
    toxicity,
)

_MODULES = (
    pii,
    mixing,
    packing,
    simhash,
    passages,
    toxicity,
    exact_dedup,
    fingerprints,
    language,
    hmm,
    sharding,
    infill,
    resampling,
)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
TWINS = {name: sql for module in _MODULES for name, sql in module.TWINS.items()}
