"""Queries of the corpus operators and the SQL that some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakekpi.llm.common import session
from lakekpi.llm import decontaminate as _bd
from lakekpi.llm import fill_in_middle as _fm
from lakekpi.llm import near_dups as _nd
from lakekpi.llm import quality as _qc
from lakekpi.llm import substring_dups as _sd
from lakekpi.llm import topk_search as _tk
from lakekpi.llm import toxicity as _tx
from lakekpi.llm import vector_codes as _vc
from lakekpi.llm import warc as _wa
from lakekpi.llm.lm import op9_lm_scores
from lakekpi.llm.packing import op10_packing
from lakekpi.llm.simhash_dups import op12_simhash_dups
from lakekpi.llm.token_counts import op5_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(fn, sql: str | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(session(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    if sql is not None:
        ORACLES[fn.__name__] = sql


_register(_tk.op1_topk_search, _tk.SQL)
_register(_bd.op2_decontaminate, _bd.SQL)
_register(_nd.op3_near_dups, _nd.SQL)
_register(_sd.op4_substring_dups, _sd.SQL)
_register(op5_token_counts)
_register(_tx.op6_toxicity)
_register(_qc.op7_quality)
_register(_wa.op8_warc, _wa.SQL)
_register(op9_lm_scores)
_register(op10_packing)
_register(_vc.op11_vector_codes, _vc.SQL)
_register(op12_simhash_dups)
_register(_fm.op13_fill_in_middle, _fm.SQL)
