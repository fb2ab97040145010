"""Registered queries of this subpackage."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import lookalike, names, packing, quality, sentences, split, tokenizer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": split.p1_found,
    "p1_pieces": split.p1_pieces,
    "p2_found": lookalike.p2_found,
    "p2_forms": lookalike.p2_forms,
    "p2_classes": lookalike.p2_classes,
    "p3_found": names.p3_found,
    "p3_groups": names.p3_groups,
    "p5_found": sentences.p5_found,
    "p7_ids": tokenizer.p7_ids,
    "p9_found": quality.p9_found,
    "p9_statistics": quality.p9_statistics,
    "p8_containers": packing.p8_containers,
}
