"""Composed jobs (TAD builds, feature factories) registered as queries."""

from __future__ import annotations

from tadkit.plans.registry import query
from tadkit.plans.tad import SUPPLIER_NATION_TAD_SQL, supplier_nation_tad
from tadkit.session import Tables


@query("c1_tad_supplier_nation", SUPPLIER_NATION_TAD_SQL)
def tad_supplier_nation(spark, sf_dir):
    """Flagship TAD: one row per nation from lineitem x supplier x nation."""
    t = Tables(spark, sf_dir)
    return supplier_nation_tad(t.lineitem, t.supplier, t.nation)
