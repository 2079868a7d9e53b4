import hashlib

import duckdb
import pandas as pd

from sensorloom.llm import queries
from tests.llm import samples

ROWS = samples.documents()


def _rows(sql):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(ROWS, columns=["doc_id", "text", "lang", "source", "n_chars"]))
    return {r[0]: r[1:] for r in con.sql(sql).fetchall()}


def test_join_sql_is_the_brute_force_join():
    assert _rows(queries.OP5_SQL) == {i: (n, c) for i, n, c in samples.components([r[:2] for r in ROWS], 4, 85)}


def test_line_sql_is_the_brute_force_dedup():
    want = {}
    for (i, text, *_), (_, kept, removed) in zip(ROWS, samples.without_later_lines([r[:2] for r in ROWS], 5, 80)):
        lines = len(text.split("\n")) if text else 0
        want[i] = (lines, removed, len(kept), hashlib.sha256(kept.encode()).hexdigest())
    assert _rows(queries.OP1_SQL) == want


def test_every_oracle_has_its_query():
    assert set(queries.oracles()) <= set(queries.queries())
