"""Report queries (R1-R6): filters, orderings and top-k sizes on the smoke tables."""

import datetime as dt

from pyspark.sql import functions as F

from threadlens.operators import reports
from threadlens.plans.layers import Layers
from tests.conftest import SMOKE


def _newest(L):
    return L.silver.agg(F.max("checkpoint_date")).first()[0]


def test_recent_reports_order_and_window(spark):
    L = Layers(spark, SMOKE)
    newest = _newest(L)
    r1 = reports.user_metrics_recent(L.gold_user, newest, 7).collect()
    keys = [(r.checkpoint_date, r.checkpoint_count) for r in r1]
    assert keys == sorted(keys, key=lambda k: (k[0], k[1]), reverse=True)
    assert min(r.checkpoint_date for r in r1) >= newest - dt.timedelta(days=7)
    r2 = reports.team_dashboard(L.gold_team, newest, 30).collect()
    assert [(r.team, r.checkpoint_date) for r in r2] == sorted((r.team, r.checkpoint_date) for r in r2)
    assert all(r.avg_checkpoints_per_user == round(r.checkpoint_count / r.user_count, 2) for r in r2)
    r3 = reports.team_summary_recent(L.gold_team, newest, 7).collect()
    assert [(r.checkpoint_date, r.team) for r in r3] == sorted((r.checkpoint_date, r.team) for r in r3)


def test_latest_and_history_reports(spark):
    L = Layers(spark, SMOKE)
    b = reports.latest_bronze(L.bronze, 10).collect()
    assert len(b) == 10 and [r.ingested_at for r in b] == sorted((r.ingested_at for r in b), reverse=True)
    assert len(reports.latest_lookup(L.history, 50).collect()) == 50
    assert len(reports.latest_silver(L.silver, 20).collect()) == 20
    h = reports.thread_history(L.history, reports.most_changed_thread(L.history)).collect()
    assert len({r.thread_id for r in h}) == 1 and [r.valid_from for r in h] == sorted(r.valid_from for r in h)
    assert sum(r.valid_to is None for r in h) == 1
