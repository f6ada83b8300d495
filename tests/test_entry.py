"""Driver contract: entry runs, every query has a callable, oracle keys
are a subset of the query keys."""

import os
import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "object_direction" in df.columns


def test_contract_shapes():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


# Query names of the blueprint's catalogue.
CATALOGUE = """road_staging road_bidirectional_rank road_group_metrics road_first_last road_direction road_objects
ads_union ads_ga_staging ads_with_ga ads_first_wins load_append_above_max load_upsert load_delete_insert
checks_report group_mean_std group_mean_sorted group_size_vs_count account_roi quarter_currency month_rates
lucky_cohort value_counts value_shares null_counts profile box_stats date_pivot correlations pct_rank_top20
anova kruskal day_period weekend late_hours share_and_rating sentinel_null dropna melt_category melt_age
melt_gender melt_city melt_age_city total_row population_bands population_yoy text_numbers fuzzy_columns
sphere_distance plane_distance trip_fare arrival zone_inside zone_visits zone_speed link_dedup clean_pages
extract_text preview summary_cut author_clean result_text first_source publish_window work_queue queue_status
status_tally search page page_count unprocessed detail_related related_top5 key_value_json stream_parquet
stream_upsert stream_zone_speed stream_dedup export_csv export_json create_missing load_summary file_year
typed_csv""".split()


def test_catalogue_is_registered():
    q = E.queries()
    assert [n for n in CATALOGUE if n not in q] == []


def test_catalogue_loads_before_any_session():
    import subprocess
    import sys
    code = "import __spark_entry__ as E; print(len(E.queries()) > 100 and len(E.oracle_sql()) > 100)"
    out = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                         capture_output=True, text=True, timeout=120)
    assert out.stdout.strip().endswith("True"), out.stderr


def test_queries_run_from_another_folder(tmp_path):
    """Workers that can't import the package get it sent."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from tributary import build_session, ship_package
import __spark_entry__ as E
spark = build_session("local[2]", 2)
q = E.queries()
print(ship_package(spark), q["clean_pages"](spark, "/root/testdata/sf0.001").count() > 0, q["stream_zone_speed"](spark, "/root/testdata/sf0.001").count() > 0)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "True True True" in out.stdout, out.stderr[-3000:]
