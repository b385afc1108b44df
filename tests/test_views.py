"""Reports as plain Spark SQL over the registered views."""

from threadlens.operators import metrics, reports
from threadlens.plans.layers import Layers
from threadlens.plans.views import register_layers
from tests.conftest import SMOKE


def test_sql_reports_over_views(spark):
    L = Layers(spark, SMOKE)
    names = register_layers(L)
    assert {"silver_checkpoints", "gold_user_team_metrics", "silver_thread_lookup_history"} <= set(names)

    by_sql = spark.sql("""
        SELECT team, checkpoint_date, SUM(checkpoint_count) AS team_checkpoint_count,
               SUM(thread_count) AS team_thread_count, COUNT(DISTINCT user_id) AS team_user_count,
               MAX(checkpoint_date) AS latest_date
        FROM gold_user_team_metrics GROUP BY team, checkpoint_date""")
    by_api = metrics.team_daily(L.gold_user)
    assert by_sql.count() == by_api.count() and by_sql.exceptAll(by_api.select(by_sql.columns)).count() == 0

    current = spark.sql("SELECT thread_id, user_id, team FROM silver_thread_lookup_history WHERE __END_AT IS NULL")
    assert current.exceptAll(reports.current_ownership(L.history)).count() == 0

    dash = spark.sql("""
        SELECT checkpoint_date, team, user_count, thread_count, checkpoint_count,
               ROUND(checkpoint_count / user_count, 2) AS avg_checkpoints_per_user
        FROM gold_team_summary
        WHERE checkpoint_date >= (SELECT MAX(checkpoint_date) FROM silver_checkpoints) - INTERVAL 30 DAYS
        ORDER BY team, checkpoint_date""")
    assert dash.count() == reports.team_dashboard(L.gold_team, L.newest_date(), 30).count()
    assert spark.sql("SELECT COUNT(*) AS n FROM bronze_checkpoints WHERE _rescued_data IS NOT NULL").first().n > 0
    assert spark.sql("SELECT COUNT(*) AS n FROM monitoring_null_percentages").first().n == 13
