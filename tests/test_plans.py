"""What the physical plans must and must not contain."""

import re

import pytest

from riverdeck.catalog import ENTRIES

BATCH = sorted(n for n in ENTRIES if not n.startswith("stream_"))


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    found = {}

    def get(name):
        if name not in found:
            found[name] = plan_of(ENTRIES[name].run(spark, sf_dir))
        return found[name]

    return get


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_no_python(plans, name):
    text = plans(name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert not re.search(r"Python|InPandas|Arrow", text)


@pytest.mark.parametrize("name", [n for n in BATCH if n not in ("leaderboard_top10",)])
def test_no_unpartitioned_window_over_rows(plans, name):
    """A window without a partition key may only see the per-slice summary."""
    for line in plans(name).splitlines():
        found = re.search(r"Window \[.*windowspecdefinition\((.*?)(ASC|DESC)", line)
        if found and "," not in found.group(1):
            assert "_slice" in found.group(1), line


@pytest.mark.parametrize("name, columns", [
    ("chi_squared_cards", {"l_partkey"}), ("card_frequency", {"l_partkey"}),
    ("total_hands_summary", {"o_orderkey", "l_orderkey", "l_linenumber", "l_partkey"}),
    ("action_distribution", {"event_type", "event_id"}), ("seed_uniqueness", {"o_orderkey", "o_custkey"})])
def test_scans_read_only_needed_columns(plans, name, columns):
    read = set()
    for schema in re.findall(r"ReadSchema: struct<(.*?)>", plans(name)):
        read |= {field.split(":")[0] for field in schema.split(",") if field}
    assert read <= columns


@pytest.mark.parametrize("name, scans", [
    ("chi_squared_cards", 1), ("card_frequency", 1), ("rank_distribution", 1), ("card_stats_refresh", 1),
    ("randomness_report", 2), ("stats_summary", 4), ("timeline_chi_squared", 1), ("play_style", 1),
    ("player_action_counts", 1)])
def test_facts_are_scanned_once(plans, name, scans):
    assert plans(name).count("FileScan parquet") == scans


def test_filters_reach_the_scan(spark, tmp_path):
    from riverdeck.operators.lookup import hands_page
    from riverdeck.schemas import TABLES
    from riverdeck.sources.tables import read_table, write_table

    rows = [(f"g{i % 3}", i, i, "s", "", "", None) for i in range(100)]
    write_table(spark.createDataFrame(rows, TABLES["poker_hands"]), str(tmp_path), "poker_hands", "block_height")
    text = plan_of(hands_page(read_table(spark, str(tmp_path), "poker_hands"), "g1", 10, 50))
    for pushed in ("EqualTo(game_id,g1)", "GreaterThanOrEqual(block_height,10)", "LessThanOrEqual(block_height,50)"):
        assert pushed in text
    assert "TakeOrderedAndProject" in text


def test_newest_hands_read_the_files_that_can_hold_them(spark, tmp_path):
    from riverdeck.operators.lookup import hands_page, newest_hands
    from riverdeck.schemas import TABLES
    from riverdeck.sources.tables import read_table, write_ranges

    rows = [(f"g{i % 3}", i, i // 2, "s", "", "", None) for i in range(3000)]  # two hands to a block
    table = spark.createDataFrame(rows, TABLES["poker_hands"])
    table.repartitionByRange(120, "block_height").write.parquet(f"{tmp_path}/poker_hands")
    write_ranges(spark, str(tmp_path), "poker_hands", "block_height")
    every = read_table(spark, str(tmp_path), "poker_hands")
    assert len(every.inputFiles()) == 120
    for limit, offset, end, most in ((50, 0, 0, 4), (7, 40, 700, 6), (1, 0, 0, 2), (1000, 2900, 0, 120), (5, 0, 1, 2), (20, 0, 5000, 4)):
        page = newest_hands(spark, str(tmp_path), end, limit, offset)
        whole = hands_page(every, end_block=end, limit=limit, offset=offset, with_total=False)
        assert page.collect() == whole.collect() and len(page.inputFiles()) <= most


def test_top_per_key_limits_before_the_shuffle(plans):
    text = plans("player_recent_actions")
    assert text.count("WindowGroupLimit") == 2


def test_wide_totals_join_without_another_shuffle(spark, sf_dir):
    """Counts and session totals are both hashed by player already; joining them moves nothing."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan_of(ENTRIES["player_stats"].run(spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hashed = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)
    assert sum(1 for keys in hashed if keys.startswith("player_address") and "," not in keys) <= 4


@pytest.mark.parametrize("name, shuffles", [
    ("sessions_fold", 5), ("state_asof", 9), ("hands_fold", 1), ("results_fold", 1), ("card_dedupe", 1),
    ("play_style", 2), ("player_action_counts", 2), ("player_recent_actions", 1), ("timeline_chi_squared", 2),
    ("decode_block_events", 0), ("cards_explode", 0)])
def test_shuffles(spark, sf_dir, name, shuffles):
    """How many times rows move, with every join a shuffle join. Of the shuffles of `sessions_fold` and
    `state_asof` one and two move all events; the others move a row per span, or snapshots."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan_of(ENTRIES[name].run(spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = re.findall(r"Exchange (?:hash|range)partitioning", text)
    assert len(found) == shuffles, text
