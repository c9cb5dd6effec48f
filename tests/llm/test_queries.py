"""Registered queries of the new operators on the smallest data: op12 against its SQL, op13 against numpy."""

import math

import duckdb
import numpy as np
import pandas as pd

from waybill.llm import queries

SF = "/root/testdata/sf0.001"


def test_op12_equals_its_sql(spark):
    got = queries.op12_collocations(spark, SF).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(queries.SQL["op12_collocations"]).df()
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    order = ["lang", "rank"]
    assert got[cols].sort_values(order).astype(str).values.tolist() == want[cols].sort_values(order).astype(str).values.tolist()


def test_op13_equals_numpy(spark):
    got = queries.op13_whitening(spark, SF).toPandas()
    rows = pd.read_parquet(f"{SF}/embeddings.parquet")
    ok = rows.embedding.map(lambda v: v is not None and all(c is not None and math.isfinite(c) for c in v))
    x = np.array([np.floor(np.asarray(v, dtype=np.float64) * 256) for v in rows.embedding[ok]]).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    ev, vec = np.linalg.eigh(c.T @ c / n)
    ev, vec = ev[::-1], vec[:, ::-1]
    ids = rows.vec_id[ok].to_numpy()
    assert set(got.n) == {n}
    for k in range(4):
        part = got[got.component == k + 1].set_index("vec_id").loc[ids]
        w = (x - s / n) @ vec[:, k] / math.sqrt(ev[k])
        assert np.allclose(np.abs(part.whitened.to_numpy()), np.abs(w), atol=1e-9)
        assert (part.deviation.to_numpy() == ((n * x - s) ** 2).sum(1)).all()
        assert abs(part.explained.iloc[0] - ev[k] / ev.sum()) <= 1e-4 * ev[k] / ev.sum()
    assert got.identity_error.max() <= 1e-4
