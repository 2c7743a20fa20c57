"""Operators for training-data pipelines, and their named queries.

Nothing else in the library imports this subpackage. `corpus_pipeline` is imported only when its
query runs, as it imports the operators itself.
"""

from __future__ import annotations

import sys
from importlib import import_module

from pyspark import cloudpickle

# functions of these modules travel with their jobs, so executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_QUERIES = {
    "op1_decontamination": "decontaminate",
    "op2_packing": "packing",
    "op3_url_filter": "url_filter",
    "op4_fingerprints": "fingerprints",
    "op5_sharding": "sharding",
    "op6_revisits": "warc",
    "op7_toxicity": "toxicity",
    "op8_suffix_dedup": "suffix_dedup",
    "op9_passages": "passages",
    "op10_simhash": "simhash",
    "op11_spelling": "spelling",
    "op12_license_scan": "license_scan",
    "op13_hard_negatives": "hard_negatives",
}


def _query(name: str):
    return getattr(import_module(f"tallyhouse.llm.{_QUERIES[name]}"), name)


def all_queries() -> dict:
    return {name: _query(name) for name in _QUERIES}


def all_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    for module in dict.fromkeys(_QUERIES.values()):
        sql |= getattr(import_module(f"tallyhouse.llm.{module}"), "SQL", {})
    return sql
