"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat_snapshots import OP5_SQL, op5_chat_snapshots
from .decontaminate import OP3_SQL, op3_decontaminate
from .jaccard_join import OP1_SQL, op1_jaccard_join
from .language_id import op7_language_id
from .mix_sources import op8_mix_sources
from .quality import op10_quality
from .secret_scan import OP2_SQL, op2_secret_scan
from .winnowing import op6_winnowing
from .token_counts import op4_token_counts
from .warc_archive import OP9_SQL, op9_warc_archive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_secret_scan": op2_secret_scan,
    "op3_decontaminate": op3_decontaminate,
    "op4_token_counts": op4_token_counts,
    "op5_chat_snapshots": op5_chat_snapshots,
    "op6_winnowing": op6_winnowing,
    "op7_language_id": op7_language_id,
    "op8_mix_sources": op8_mix_sources,
    "op9_warc_archive": op9_warc_archive,
    "op10_quality": op10_quality,
}

ORACLE_SQL: dict[str, str] = {
    "op1_jaccard_join": OP1_SQL,
    "op2_secret_scan": OP2_SQL,
    "op3_decontaminate": OP3_SQL,
    "op5_chat_snapshots": OP5_SQL,
    "op9_warc_archive": OP9_SQL,
}
