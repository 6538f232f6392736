"""Bootstrap replicates against plain Python that draws every row."""
import numpy as np
import pytest

from lendspark.functions.local import local_frame
from lendspark.operators import bootstrap as bs

R = 30


def plain(rows, r):
    """AUC of replicate r, from each row's own draw."""
    w = bs.row_weights(np.array([x[0] or 0 for x in rows], dtype=np.int64), r + 1)[:, r]
    s, y = np.array([x[1] for x in rows]), np.array([x[2] for x in rows])
    pos, neg = w * y, w * (1 - y)
    won = (pos[:, None] * neg[None, :] * ((s[:, None] > s[None, :]) + 0.5 * (s[:, None] == s[None, :]))).sum()
    return won / (pos.sum() * neg.sum())


@pytest.mark.parametrize("scores", [1, 3, 40])
def test_every_row_has_its_own_draw(spark, monkeypatch, scores):
    monkeypatch.setattr(bs, "DRAWS_AT_ONCE", 7 * R)
    monkeypatch.setattr(bs, "ROWS_PER_TASK", 20)             # one score's rows lie in several ranges
    rng = np.random.default_rng(scores)
    rows = [(i if i % 50 else None, float(rng.integers(scores)) / 8, int(rng.random() < 0.4)) for i in range(400)]
    frame = local_frame(spark, [(i, s if s else -0.0 if k % 2 else 0.0, y) for k, (i, s, y) in enumerate(rows)], "id long, s double, y int")
    got = {r["replicate"]: r["auc"] for r in bs.replicate_aucs(frame.select(*bs._row("s", "y", "id")), [], R).collect()}
    assert got == pytest.approx({r: plain(rows, r) for r in range(R)})


def test_paired_scores_share_a_row_s_draw(spark):
    rows = [(i, (i * 37 % 11) / 10, (i * 37 % 11) / 5, int(i % 3 == 0)) for i in range(120)]
    got = bs.paired_difference(local_frame(spark, rows, "id long, a double, b double, y int"), "id", "a", "b", "y", R).first()
    assert (got["difference"], got["ci_low"], got["ci_high"], got["p_value"], got["replicates"]) == (0.0, 0.0, 0.0, 1.0, R)
