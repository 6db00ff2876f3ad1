"""The queries of this subpackage; none of them can be put in SQL, so each is tested against brute force."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marsad.llm import leaks, mixing, neardup, packing, pairs, residue, subjects, unify

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": pairs.p1_found,
    "p1_labels": pairs.p1_labels,
    "p2_found": unify.p2_found,
    "p2_groups": unify.p2_groups,
    "p2_consistent_texts": unify.p2_consistent_texts,
    "p3_found": leaks.p3_found,
    "p3_items": leaks.p3_items,
    "p4_found": residue.p4_found,
    "p4_kinds": residue.p4_kinds,
    "p5_found": neardup.p5_found,
    "p5_groups": neardup.p5_groups,
    "p6_sequences": packing.p6_sequences,
    "p6_fill": packing.p6_fill,
    "p7_mix": mixing.p7_mix,
    "p7_shares": mixing.p7_shares,
    "p8_found": subjects.p8_found,
    "p8_composition": subjects.p8_composition,
}

SQL: dict[str, str] = {}
