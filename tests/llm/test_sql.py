"""The SQL of the operators that have one, against the operators on the awkward rows."""

import sys
from pathlib import Path

import duckdb

from quarrydesk.llm import parity_join, substring_dedup
from quarrydesk.llm.oracles import ORACLES

sys.path.insert(0, str(Path(__file__).parent.parent))
from compare import differences  # noqa: E402

sys.path.insert(0, str(Path(__file__).parent))
from test_operators import TEXTS  # noqa: E402


def _both(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(TEXTS.items()))
    return con, spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string")


def test_parity_join(spark):
    con, docs = _both(spark)
    assert differences(parity_join.near_duplicate_components(docs), con, ORACLES["op1_parity_join"]) == []


def test_substring_dedup(spark):
    con, docs = _both(spark)
    found = substring_dedup.remove_repeats(docs, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert differences(found, con, ORACLES["op5_substring_dedup"]) == []
