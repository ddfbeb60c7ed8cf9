"""The queries of this subpackage, pN_... for problem N, and SQL for those that SQL can express on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import boilerplate, clusters, leaks, levels, nearduplicates, scans, similar, spans, tokenize


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": spans.p1_found,
        "p1_shares": spans.p1_shares,
        "p2_found": scans.p2_found,
        "p2_pages": scans.p2_pages,
        "p3_found": clusters.p3_found,
        "p3_clusters": clusters.p3_clusters,
        "p4_found": nearduplicates.p4_found,
        "p4_groups": nearduplicates.p4_groups,
        "p5_found": similar.p5_found,
        "p5_neighbours": similar.p5_neighbours,
        "p6_found": boilerplate.p6_found,
        "p6_clean": boilerplate.p6_clean,
        "p7_ids": tokenize.p7_ids,
        "p7_texts": tokenize.p7_texts,
        "p8_found": leaks.p8_found,
        "p8_spans": leaks.p8_spans,
        "p8_clean": leaks.p8_clean,
        "p9_found": levels.p9_found,
        "p9_profile": levels.p9_profile,
    }


def oracle_sql() -> dict[str, str]:
    return {"p1_found": spans.P1_SQL, "p1_shares": spans.P1_SHARES_SQL, "p3_found": clusters.P3_SQL, "p4_found": nearduplicates.P4_SQL, "p5_found": similar.P5_SQL, "p6_found": boilerplate.P6_SQL, "p7_texts": tokenize.P7_TEXTS_SQL, "p8_found": leaks.P8_SQL, "p8_spans": leaks.P8_SPANS_SQL}
