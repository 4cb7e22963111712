"""A whole run: landed documents to tables to reports."""

from riverdeck import indexing, schemas, sql, staging
from riverdeck.sources import blocks


def test_landed_documents_become_tables_and_reports(spark, sf_dir, tmp_path):
    landed = staging.landed_blocks(spark, sf_dir)
    events = blocks.flatten(blocks.block_events(spark, landed))
    heights = blocks.scanned_heights(spark.read.schema(schemas.BLOCK_RESULTS).json(landed))
    tables = indexing.index_tables(
        events, heights, blocks.headers(spark, staging.landed_headers(spark, sf_dir)),
        blocks.game_states(spark, staging.landed_states(spark, sf_dir)))
    indexing.write_index(tables, str(tmp_path))
    read = sql.register_tables(spark, str(tmp_path), *tables)
    for name, table in read.items():
        assert table.schema.simpleString() == schemas.TABLES[name].simpleString()
        assert table.count() > 0, name
    sql.register_card_views(spark, read["poker_hands"], read["hand_results"], read["revealed_cards"])
    sql.register_player_views(spark, read["player_actions"], read["player_sessions"])
    assert spark.sql("SELECT * FROM generate_randomness_report()").count() in (1, 5)
    started, games = spark.sql("SELECT total_hands_started, unique_games FROM total_hands_summary").first()
    assert started == read["poker_hands"].count() and games == 5
    acted = spark.sql("SELECT sum(total_actions) FROM player_stats").first()[0]
    assert acted == read["player_actions"].count()
    assert spark.sql("SELECT last_scanned_block FROM indexing_progress").first()[0] % 100 == 0
