"""Operator 6 where cells are crowded and cut into tiles, up to one dense spot."""

import numpy as np

from ledgerline.llm import embed


def crowd(seed=4, dim=32):
    r = np.random.default_rng(seed)
    noise = lambda size: r.normal(size=(*size, dim)) / dim**0.5
    base = noise(())
    centres = base / np.linalg.norm(base) + 0.35 * noise((200,))
    near = (centres[:, None, :] + 0.12 * noise((200, 3))).reshape(-1, dim)
    spot = -base + 0.01 * noise((70,))
    return np.concatenate([near, spot])


def test_links_in_crowded_cells(spark, monkeypatch):
    monkeypatch.setattr(embed, "TILE", 24)
    x = crowd()
    rows = [(i, v.tolist(), "clash", 1) for i, v in enumerate(x)]
    rows += [(1000, x[0].tolist(), "clash", 1), (1001, x[0].tolist(), "clash", 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string, label int")
    got = {r.vec_id: r for r in embed.near_duplicates(table.withColumn("cell", table.node).withColumn("k", table.node)).collect()}
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1)[:, None]
    label = np.array([r[3] for r in rows])
    link = (u @ u.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(link, False)
    wanted = dict(zip((r[0] for r in rows), link.sum(axis=1).tolist(), strict=True))
    assert all(got[i].n_links <= n for i, n in wanted.items())
    assert sum(r.n_links for r in got.values()) >= 0.98 * sum(wanted.values())
    assert all(got[i].n_links >= 69 and got[i].component_id == 600 for i in range(600, 670))
    assert got[1000].component_id == got[0].component_id and got[1001].n_links == 0 and got[1001].kept
