"""Registered queries of the subpackage and their SQL where there is one."""

from __future__ import annotations

from newsloom.llm import address, consensus, forest, lookalike, mixing, packing, sigtree, spans, sql


def queries() -> dict:
    return {
        "p1_found": forest.p1_found,
        "p1_batches": forest.p1_batches,
        "p2_found": lookalike.p2_found,
        "p2_classes": lookalike.p2_classes,
        "p2_forms": lookalike.p2_forms,
        "p4_found": address.p4_found,
        "p4_records": address.p4_records,
        "p5_found": consensus.p5_found,
        "p5_records": consensus.p5_records,
        "p6_found": sigtree.p6_found,
        "p6_groups": sigtree.p6_groups,
        "p7_containers": packing.p7_containers,
        "p7_fill": packing.p7_fill,
        "p8_selection": mixing.p8_selection,
        "p8_shares": mixing.p8_shares,
        "p9_found": spans.p9_found,
        "p9_spans": spans.p9_spans,
        "p9_classes": spans.p9_classes,
        "p9_coverage": spans.p9_coverage,
    }


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
