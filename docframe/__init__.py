"""docframe: lazy document frames on Spark DataFrames."""

import importlib

_HOMES = {
    "DocFrame": "docframe.operators.frame",
    "GroupedDocFrame": "docframe.operators.grouped",
    "Facets": "docframe.operators.facets",
    "DocSchema": "docframe.sources.schema",
    "FieldInfo": "docframe.sources.schema",
    "Store": "docframe.sources.store",
    "Field": "docframe.plans.formula",
    "I": "docframe.plans.formula",
    "Cut": "docframe.plans.formula",
    "DateCut": "docframe.plans.formula",
}


def __getattr__(name: str):
    """Public names load their module on first use, so that Python workers import no more than they need."""
    if name in _HOMES:
        return getattr(importlib.import_module(_HOMES[name]), name)
    raise AttributeError(name)
