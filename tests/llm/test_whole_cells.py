"""Operator 6: all that meets in a cell is compared, also where cells are crowded."""

import numpy as np

from ledgerline.llm import embed


def test_crowded_cells_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(embed, "TILE", 24)
    r = np.random.default_rng(1)
    x = 0.35 * r.normal(size=(300, 8)) / 8**0.5 + np.eye(8)[0]
    apart = r.normal(size=x.shape)
    x = np.concatenate([x, x + 0.19 * apart / np.linalg.norm(apart, axis=1)[:, None]])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.98
    np.fill_diagonal(link, False)
    meet = np.zeros_like(link)
    for t in range(embed.TABLES):
        own = embed.cells(u, t)
        for p in own.T:
            for q in own.T:
                meet |= p[:, None] == q[None, :]
    want = (link & (meet | meet.T)).sum(axis=1)
    got = embed.near_duplicates(spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int"))
    assert [row.n_links for row in got.orderBy("vec_id").collect()] == want.tolist() and want.sum() > 1000
