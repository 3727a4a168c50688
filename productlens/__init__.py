"""productlens: product analytics (cleaning, sessions, adoption, retention, revenue, reports) on Spark.

Typical use::

    from productlens import Marts, Warehouse, pipeline, reports
    marts = Marts(base_tables, feature="team_collab")      # lazy DataFrames for every table
    pipeline.run(spark, base_tables, "/shared/warehouse")   # materialise in dependency order
    reports.run(spark, "/shared/warehouse", "/shared/reports")
"""

import importlib

_EXPORTS = {
    "Marts": ("productlens.plans.marts", "Marts"),
    "TABLE_LAYERS": ("productlens.plans.marts", "TABLE_LAYERS"),
    "Warehouse": ("productlens.sources.warehouse", "Warehouse"),
    "pipeline": ("productlens.plans.pipeline", None),
    "reports": ("productlens.plans.reports", None),
}


def __getattr__(name):  # lazy, so Python workers importing one module do not load everything
    if name not in _EXPORTS:
        raise AttributeError(name)
    module, attr = _EXPORTS[name]
    mod = importlib.import_module(module)
    return getattr(mod, attr) if attr else mod
